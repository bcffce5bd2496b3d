import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import signature
from tidemark.operators.metrics import MetricSpec
from tidemark.operators.transforms import with_temp
from tidemark.plans.jobs import Job
from tidemark.session import shared_folder
from tidemark.sinks import records as rec
from tidemark.sinks import tables as tb


def test_target_names(spark):
    df = spark.range(1)
    name = tb.target_name("city-{dateformat=yyyy.MM.dd}", datetime(2024, 3, 4))
    assert df.select(name).first()[0] == "city-2024.03.04"
    assert df.select(tb.target_name("plain", datetime(2024, 3, 4))).first()[0] == "plain"


def test_route_by_file_has_a_default(spark):
    df = spark.createDataFrame([("/x/batchtest.txt",), ("/x/cityperson.txt",), ("/x/other",)], "file string")
    out = tb.route_by_file(df, "file", {"batchtest.txt": "b", "cityperson.txt": "c"}, "c")
    assert [r._target for r in out.collect()] == ["b", "c", "c"]


def test_rolling_files_hold_no_more_than_asked(spark, tmp_path):
    df = spark.range(0, 95, 1, 3)
    tb.rolling_write(df, str(tmp_path / "exact"), 10, "r1", ["id"])
    files = sorted((tmp_path / "exact" / "run=r1").glob("file_seq=*/*.json"))
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert len(files) == 10 and sizes == [10] * 9 + [5]
    assert [json.loads(line)["id"] for line in files[3].read_text().splitlines()] == list(range(30, 40))
    tb.rolling_write(df, str(tmp_path / "loose"), 10, "r1")
    sizes = [len(f.read_text().splitlines()) for f in (tmp_path / "loose" / "run=r1").glob("*.json")]
    assert sum(sizes) == 95 and max(sizes) <= 10


def test_envelope_batches_are_bounded_and_signed(spark):
    df = spark.range(25).select("id", F.lit("x").alias("t"))
    out = rec.envelope(df, ["id"], 10, {"app": "a", "n": 1}).orderBy("batch_no").collect()
    assert [r.records for r in out] == [10, 10, 5]
    body = json.loads(out[1].body)
    assert (body["app"], body["n"]) == ("a", 1)
    assert [d["id"] for d in body["datas"]] == list(range(10, 20))
    datas = json.dumps(body["datas"], separators=(",", ":"))
    assert body["signature"] == out[1].signature == spark.range(1).select(signature(F.lit(datas))).first()[0]


def test_delimited_records(spark):
    df = spark.createDataFrame([(None, "a|b\r\nc", 1), ("x", None, 2)], "p string, d string, n int")
    out = rec.delimited_record(df, ["p", "n", "d"], "|", escape=["d"])
    assert rows(out) == [("x|2|",), ("|1|a__bc",)]


def test_custom_sink_gets_batches_and_context(spark, tmp_path):
    folder = str(tmp_path)

    def save(batch, context):
        import os
        import uuid

        with open(os.path.join(context["folder"], uuid.uuid4().hex), "w") as out:
            out.write(json.dumps(batch))

    tb.custom_sink(spark.range(0, 25, 1, 2), save, batch_size=5, context={"folder": folder})
    batches = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert max(map(len, batches)) <= 5
    assert sorted(r["id"] for b in batches for r in b) == list(range(25))


def test_sink_limit_needs_an_order(spark):
    with pytest.raises(ValueError):
        tb.Sink("x", tb.noop_sink, limit=2).frame(spark.range(3))
    assert tb.Sink("x", tb.noop_sink, limit=2, order=["id"]).frame(spark.range(3)).count() == 2


def test_routed_rows_land_in_their_folders(spark, tmp_path):
    df = spark.range(100).withColumn("_target", F.when(F.col("id") < 90, "big").otherwise("small"))
    tb.write_routed(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "_target=small")).count() == 10
    assert spark.read.parquet(str(tmp_path / "out" / "_target=big")).count() == 90


def test_replayed_batch_is_stored_once(spark, tmp_path):
    path, schema = str(tmp_path / "c"), "op string, seq int, id int, v string"
    one = spark.createDataFrame([("I", 1, 1, "a"), ("U", 2, 1, "b")], schema)
    for _ in range(2):
        tb.append_changes(one, path, 0, ["id"])
    assert rows(tb.read_changes(spark, path, schema)) == [("U", 2, 1, "b", 0)]


def test_job_keeps_temp_fields_out_of_the_output(spark, tmp_path):
    kept = []
    job = Job(
        transforms=[lambda df: with_temp(df, parity=F.col("id") % 2)],
        outputs=[tb.Sink("detail", lambda df: kept.append(df.columns) or tb.overwrite(df, str(tmp_path / "d")))],
        metrics=[MetricSpec("parity", "_tmp_parity")],
        metric_sink=lambda df: tb.overwrite(df.select("metric", "count"), str(tmp_path / "m")), labels=(),
    )
    job.run(spark.range(7))
    assert kept == [["id"]]
    assert rows(spark.read.parquet(str(tmp_path / "m"))) == [("0", 4), ("1", 3)]


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://x/ckpt/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_folder(Session(), "a").startswith("hdfs://x/ckpt/a-")
    assert shared_folder(spark, "a") != shared_folder(spark, "a")


def test_merge_is_refused_by_plain_files(spark, tmp_path):
    """No table format that can merge is in this image: the statement gets as far as the table."""
    spark.sql(f"CREATE TABLE plain_target (id int, v string) USING parquet LOCATION '{tmp_path}/t'")
    try:
        changes = spark.createDataFrame([("U", 1, 1, "a")], "op string, seq int, id int, v string")
        with pytest.raises(Exception, match="MERGE"):
            tb.merge_into(changes, "plain_target", ["id"])
    finally:
        spark.sql("DROP TABLE plain_target")


def test_the_copy_of_a_fan_out_goes(spark, tmp_path, monkeypatch):
    import tidemark.session as session

    monkeypatch.setattr(session, "shared_folder", lambda spark, name: str(tmp_path / name))
    sinks = [tb.Sink(n, lambda df, n=n: tb.overwrite(df, str(tmp_path / n))) for n in ("a", "b")]
    tb.fan_out(spark.range(5), sinks)
    assert spark.read.parquet(str(tmp_path / "a")).count() == spark.read.parquet(str(tmp_path / "b")).count() == 5
    assert not (tmp_path / "fan-out").exists()
