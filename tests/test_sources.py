import tarfile
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.numbering import first_n, number_rows
from tidemark.sources import files as fs
from tidemark.sources import records as rc
from tidemark.sources import tables as tb
from tidemark.sinks.commits import CommitConflict
from tidemark.sources.state import StateTable, state_id


def test_sql_scan_options():
    plain = tb.sql_scan_options("jdbc:x", "select 1", driver="d", user="me")
    assert plain == {"url": "jdbc:x", "fetchsize": "5000", "user": "me", "driver": "d", "query": "select 1"}
    split = tb.sql_scan_options("jdbc:x", "select * from t", split=("id", 0, 100, 4))
    assert split["dbtable"] == "(select * from t) extract_rows"
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    assert "query" not in split


def test_named_queries_from_a_file(spark, tmp_path):
    path = tmp_path / "queries.xml"
    path.write_text("""<?xml version="1.0"?><properties>
      <property name="newer"><![CDATA[select id from numbers where @{condition} ## only new rows
      ]]></property>
      <property name="condition"><![CDATA[id > #[last,type=long] and id <= #[last] + #[size]]]></property>
      <property name="loop">@{loop}</property></properties>""")
    catalog = tb.load_catalog(str(path))
    got = tb.named_query(spark, catalog, "newer", {"numbers": spark.range(10)}, last=3, size=2, unused="x")
    assert rows(got) == [(4,), (5,)]
    with pytest.raises(ValueError):
        tb.resolve_query(catalog, "loop")


def test_runs_of_an_increment_make_up_the_table(spark, tmp_path):
    df = spark.range(100).withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)"))
    last, seen = None, []
    for minute in (30, 30, 70, 200):
        step = tb.incremental_scan_ts(df, "ts", last, datetime(2024, 1, 1) + timedelta(seconds=minute), 10)
        seen += [r.id for r in step.rows.collect()]
        last = step.mark()
    assert sorted(seen) == list(range(100))
    assert last == datetime(2024, 1, 1, 0, 1, 39)


def test_increment_filters_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    step = tb.incremental_scan_ts(events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))
    plan = step.rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_ties_at_the_mark_are_left_to_the_end_offset(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    step = tb.incremental_scan(df, "id", 1)
    assert len(step.rows.collect()) == 2 and step.mark() == 2
    again = tb.incremental_scan(df, "id", 2)
    assert again.rows.collect() == [] and again.mark() == 2


def test_state_table(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    assert state.read("a", default=0) == 0
    state.commit("a", 5)
    state.commit("b", datetime(2024, 1, 2, 3, 4, 5, 6))
    state.commit("a", 3)
    assert state.read("a") == 3
    assert state.read("b") == datetime(2024, 1, 2, 3, 4, 5, 6)
    assert state.read("a", default=0, from_first=True) == 0
    assert state_id("job") == "job" and state_id("job", "q1") != state_id("job", "q2")


def test_slices_are_disjoint_and_complete(spark):
    df = spark.range(1000)
    parts = [{r.id for r in tb.slice_scan(df, "id", i, 4).collect()} for i in range(4)]
    assert sum(map(len, parts)) == 1000 and set().union(*parts) == set(range(1000))


@pytest.mark.parametrize("per_range", [7, 50, 10_000])
def test_number_rows_over_many_ranges(spark, per_range):
    # A third of the rows share the first order column.
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id")).alias("k"), "id").repartition(5)
    got = number_rows(df, ["k", "id"], rows_per_range=per_range).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(300))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


@pytest.mark.parametrize("per_range", [7, 50, 10_000])
@pytest.mark.parametrize("only", [(0, 4), (120, 140), (295, 400), (500, 600)])
def test_number_rows_of_one_page(spark, per_range, only):
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("id")).repartition(5)
    got = number_rows(df, ["id"], rows_per_range=per_range, only=only).orderBy("row_no").collect()
    assert [r.row_no for r in got] == [r.id for r in got] == list(range(only[0], min(only[1] + 1, 300)))


def test_number_rows_over_a_thousand_ranges(spark):
    df = spark.range(5_000).select((F.col("id") * 7 % 5_000).alias("id"))
    got = number_rows(df, ["id"], rows_per_range=5, only=(2_000, 2_999)).collect()
    assert sorted((r.row_no, r.id) for r in got) == [(i, i) for i in range(2_000, 3_000)]


def test_number_rows_with_nulls_and_text(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), (None, 4), ("c", 5)], "k string, id int")
    got = number_rows(df, ["k", "id"], start=1, rows_per_range=1).orderBy("row_no").collect()
    assert [r.id for r in got] == [1, 4, 3, 2, 5] and [r.row_no for r in got] == [1, 2, 3, 4, 5]


def test_deep_page_equals_sorted_slice(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("id"))
    assert rows(tb.page(df, ["id"], 120, 5)) == [(120,), (121,), (122,), (123,), (124,)]
    assert rows(tb.page(df, ["id"], 498, 5)) == [(498,), (499,)]


def test_pages_by_key(spark):
    df = spark.range(10)
    page, seen = tb.page_after(df, ["id"], None, 4).collect(), []
    while page:
        seen += [r.id for r in page]
        page = tb.page_after(df, ["id"], [page[-1].id], 4).collect()
    assert seen == list(range(10))


def test_first_n_cuts_before_the_shuffle(spark):
    df = spark.range(100).withColumn("b", F.col("id") % 2)
    out = first_n(df, 2, ["id"], "b")
    assert rows(out.select("id")) == [(0,), (1,), (2,), (3,)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_csv_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text('H1,H2,H3\n1,"x,y",z\n2,b\n')
    mapping = {0: "id", 1: "name", 2: "last", 16: "missing"}
    wanted = [("1", "x,y", "z", None), ("2", "b", None, None)]
    assert rows(fs.csv_scan(spark, str(tmp_path), mapping, skip_lines=1)) == wanted
    (tmp_path / "a.csv").write_text('title\nH1,H2,H3\n1,"x,y",z\n2,b\n')
    assert rows(fs.csv_scan(spark, str(tmp_path), mapping, skip_lines=2)) == wanted


def test_lines_to_skip_go_on_in_later_blocks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("".join(f"title {i}\n" for i in range(100)) + "".join(f"{i},n{i}\n" for i in range(40)))
    (tmp_path / "b.csv").write_text("only titles\n" * 7)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = fs.csv_scan(spark, str(tmp_path), {0: "id", 1: "name"}, skip_lines=100)
        assert sorted(int(r.id) for r in got.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_gb2312_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("编号,名称\n1,解放\n2,小康\n".encode("gb2312"))
    assert rows(fs.text_lines(spark, str(tmp_path), "GB2312").select("line")) == [("1,解放",), ("2,小康",), ("编号,名称",)]
    got = fs.csv_scan(spark, str(tmp_path), {0: "id", 1: "name"}, skip_lines=1, encoding="GB2312")
    assert rows(got) == [("1", "解放"), ("2", "小康")]


def test_multiline_scan_over_small_blocks(spark, tmp_path):
    records = ["lead in"] + [f"[2024] head {i}\n body of {i}\n\n end {i}" for i in range(200)]
    (tmp_path / "a.log").write_text("\n".join(records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = fs.multiline_scan(spark, str(tmp_path), r"^\[\d{4}\]").orderBy("record_no").collect()
        lines = fs.with_pointer(fs.text_lines(spark, str(tmp_path))).collect()
        assert len({r.block_start for r in lines}) > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.record for r in got] == records
    data = (tmp_path / "a.log").read_bytes()
    for r in lines:
        assert data[r.pointer:r.pointer + r.line_bytes].decode() == r.line


def test_restart_inside_a_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\nthree\n")
    assert rows(fs.from_pointer(fs.text_lines(spark, str(tmp_path)), 4).select("line", "pointer")) == [("three", 8), ("two", 4)]


def test_multiline_column(spark):
    df = spark.createDataFrame([(1, "x\n#a\nb\n#c"), (2, "#only"), (3, "no head\nat all")], "id int, t string")
    assert rows(rc.multiline_records(df, "t", "^#")) == [
        (1, 0, "x"), (1, 1, "#a\nb"), (1, 2, "#c"), (2, 0, "#only"), (3, 0, "no head\nat all"),
    ]


def test_truncate_bytes_drops_a_cut_character(spark):
    df = spark.createDataFrame([("aé漢b",), ("ab",), (None,), ("漢�",)], "t string")
    for size in range(0, 9):
        got = [r.t for r in rc.truncate_bytes(df, "t", size).collect()]
        wanted = [None if t is None else t.encode()[:size].decode("utf-8", "ignore") for t in ("aé漢b", "ab", None, "漢�")]
        assert got == wanted, size


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("in/a.txt", "1\n2\n3\n")
        archive.writestr("b.csv", "x\ny")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    got = fs.archive_scan(spark, str(tmp_path / "*.zip"), "zip", member_regex=r"\.txt$")
    assert rows(got.select("member", "line_no", "line")) == [("in/a.txt", 0, "1"), ("in/a.txt", 1, "2"), ("in/a.txt", 2, "3")]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as archive:
        archive.add(tmp_path / "a.zip", "skip.zip")
        (tmp_path / "c.txt").write_text("é\nz")
        archive.add(tmp_path / "c.txt", "c.txt")
    got = fs.archive_scan(spark, str(tmp_path / "*.tar.gz"), "tar.gz", member_regex=r"\.txt$")
    assert rows(got.select("member", "line")) == [("c.txt", "z"), ("c.txt", "é")]
    with pytest.raises(ValueError):
        fs.archive_scan(spark, str(tmp_path), "rar")


def test_members_of_an_archive_are_dealt_out(spark, tmp_path):
    import zipfile

    from pyspark.sql import functions as F

    lines = {f"m{i}.txt": [f"{i}.{j} é" for j in range(i * 3000 % 9001)] for i in range(12)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in lines.items():
            archive.writestr(name, "\n".join(content))
    listed = fs.zip_members(spark.read.format("binaryFile").load(str(tmp_path)).select("path"))
    assert sorted(r.member for r in listed.collect()) == sorted(lines)
    got = fs.archive_scan(spark, str(tmp_path))
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    found = {}
    for r in got.orderBy("member", "line_no").collect():
        assert r.line_no == len(found.setdefault(r.member, []))
        found[r.member].append(r.line)
    assert found == {name: content for name, content in lines.items() if content}


def test_select_files(spark, tmp_path):
    for name in ("log_20240101.txt", "log_20240301.txt", "other_20240301.txt", "log_20240301.csv"):
        (tmp_path / name).write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "log_20240401.txt").write_text("x")

    def names(**how):
        return [r[0] for r in rows(fs.select_files(spark, str(tmp_path), **how).select("file_name"))]

    assert names(prefix="log_", suffix=".txt") == ["log_20240101.txt", "log_20240301.txt"]
    assert names(prefix="log_", suffix=".txt", date_prefix="log_", after=datetime(2024, 2, 1)) == ["log_20240301.txt"]
    assert names(regex=r"log_.*", recursive=True)[-1] == "log_20240401.txt"
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert names(min_age_s=3600, now=now) == []
    assert len(names(min_age_s=3600, now=now + timedelta(hours=2))) == 4
    with pytest.raises(ValueError):
        names(min_age_s=5)


def test_messages_keep_negative_keys(spark):
    df = spark.createDataFrame([(-5,), (2**40,), (None,)], "k bigint")
    from tidemark.sinks.records import encode_messages

    sent = encode_messages(df.withColumn("v", F.col("k")), "k", "t", ["v"], key_type="long")
    assert rows(rc.decode_messages(sent, "v bigint").select("key", "v")) == rows(df.select("k", "k"))


def test_change_feed_of_no_table_is_empty(spark):
    df = spark.createDataFrame([("a", "t", 1), ("b", "t", 2)], "database string, table string, seq int")
    assert rows(rc.change_feed(df, ["a.t", "c.t"])) == [("a", "t", 1)]
    assert rc.change_feed(df, []).count() == 0


def test_history_then_tail_without_history(spark):
    live = spark.range(3).withColumnRenamed("id", "seq")
    assert rows(rc.history_then_tail(live.limit(0), live, "seq")) == [(0,), (1,), (2,)]


def test_split_scan_defaults(spark):
    df = spark.createDataFrame([("1;x;2024-01-02",), (";;",), ("a",)], "line string")
    spec = [rc.Cell(0, "n", "int", default=-1), rc.Cell(1, "t", default="none"),
            rc.Cell(2, "d", "timestamp_ntz", fmt="yyyy-MM-dd")]
    assert rows(rc.split_scan(df, "line", ";", spec)) == [
        (-1, "", None), (-1, "none", None), (1, "x", datetime(2024, 1, 2)),
    ]


def test_filters_pass_a_parsed_column(spark, sf_dir):
    """A filter on parsed fields does not parse again; one on other fields reaches the scan."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = rc.json_scan(events, "props", "k int").filter("k > 5 and value > 100")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") == 1
    assert "GreaterThan(value,100.0)" in plan
    assert out.count() == events.filter("value > 100 and get_json_object(props, '$.k') > 5").count()


def test_windows_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\r\n\r\nla\rst")
    lines = fs.with_pointer(fs.text_lines(spark, str(tmp_path)))
    assert rows(lines.select("pointer", "line")) == [(0, "one"), (10, ""), (12, "la\rst"), (5, "two")]


def test_of_two_runs_of_a_job_one_fails(spark, tmp_path):
    one, two = (StateTable(spark, str(tmp_path / "state")) for _ in range(2))
    assert one.read("a/b job") is None and two.read("a/b job") is None
    one.commit("a/b job", 5)
    with pytest.raises(CommitConflict):
        two.commit("a/b job", 4)
    assert two.read("a/b job") == 5
    two.commit("a/b job", 6)
    two.commit("a/b job", 7)
    assert StateTable(spark, str(tmp_path / "state")).read("a/b job") == 7
    assert one.read("other", default=3) == 3


def test_many_runs_leave_few_files(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    for mark in range(1000):
        state.commit("job", mark)
    assert state.read("job") == 999
    assert len(list((tmp_path / "state" / "job=job").glob("*.json"))) == 16
