from datetime import datetime, timedelta

import pytest
from conftest import rows
from oracle import connect, differences
from pyspark.sql import functions as F, types as T

from tidemark.operators.changes import apply_changes
from tidemark.operators.metrics import (
    SEARCH_EVENT, MetricSpec, behaviour_days, behaviour_words, count_of, greatest_of, key_time_metric, mean_of, merge_behaviour_words, multi_metric, total_of,
)
from tidemark.plans import jobs, scan_queries
from tidemark.plans.catalog import QUERIES
from tidemark.plans.jobs import Job
from tidemark.sinks.batches import store_batch
from tidemark.sinks.tables import read_changes
from tidemark.sources.state import StateTable
from tidemark.sources.tables import incremental_scan
from tidemark.streaming import (
    drain, file_stream, late_rows, latest_counts, latest_metrics, run_increment, stream_apply, stream_key_time_metric,
    store_partials, stored_partials, stream_multi_metric, trigger_options, write_updates,
)

SCHEMA = "id bigint, k string, ts timestamp_ntz"


def write(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def test_stream_equals_batch_over_several_files(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(5):
        write(spark, path, [(j, f"k{j % 3}", at(i * 5 + j / 60)) for j in range(i * 50, i * 50 + 50)])
    schema = spark.read.parquet(path).schema
    stream = stream_key_time_metric(file_stream(spark, path, schema, max_files=1), "k", "ts", "hour", "10 days")
    query = write_updates(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    drain(query)
    got = latest_counts(spark, str(tmp_path / "out"), ["metric", "data_time"], stream.schema)
    batch = key_time_metric(spark.read.parquet(path), "k", "ts", "hour", labels=())
    assert rows(got) == rows(batch.select("metric", "data_time", "count"))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    dropped = 0
    for batch in ([(1, "a", at(0))], [(2, "a", at(48))], [(3, "a", at(1)), (4, "a", at(49))]):
        write(spark, path, batch)
        schema = spark.read.parquet(path).schema
        stream = stream_key_time_metric(file_stream(spark, path, schema, max_files=1), "k", "ts", "hour", "1 hour")
        query = write_updates(stream, out, ckpt)
        drain(query)
        dropped += late_rows(query)
    got = latest_counts(spark, out, ["metric", "data_time"], stream.schema)
    assert rows(got) == [("a", at(0), 1), ("a", at(48), 1), ("a", at(49), 1)]
    assert dropped == 1


def test_append_mode_holds_the_open_window(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [(1, "a", at(0)), (2, "a", at(5))])
    stream = stream_key_time_metric(file_stream(spark, path, spark.read.parquet(path).schema), "k", "ts", "hour")
    query = stream.writeStream.format("memory").queryName("closed").outputMode("append").trigger(**trigger_options()).start()
    drain(query)
    assert rows(spark.table("closed")) == [("a", at(0), 1)]


def test_long_windows_are_rolled_up(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_key_time_metric(spark.range(1), "id", "id", "month")
    assert trigger_options(5) == {"processingTime": "5 seconds"}


def test_finished_files_are_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    for i in range(3):
        write(spark, str(source), [(i, "a", at(i))])
    schema = spark.read.parquet(str(source)).schema
    stream = file_stream(spark, str(source), schema, max_files=1, archive_dir=str(archive), max_age="7d")
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    drain(query)
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3


def test_changes_as_a_stream_with_restart(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = "op string, seq bigint, before struct<id:int,v:string>, after struct<id:int,v:string>"
    target = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string")
    batches = [
        [("U", 1, (1, "old"), (1, "x")), ("I", 2, None, (3, "n"))],
        [("D", 3, (1, "x"), None), ("U", 4, (3, "n"), (3, "m"))],
    ]
    for data in batches:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        drain(stream_apply(stream, out, ["id"], ckpt))
    stored = read_changes(spark, out, "op string, seq bigint, id int, v string")
    assert rows(apply_changes(target, stored, ["id"])) == [(2, "old"), (3, "m")]


def test_a_failed_run_is_repeated(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    source = spark.range(10)

    def scan(last):
        return incremental_scan(source, "id", last)

    def fail(df):
        raise RuntimeError("target is away")

    with pytest.raises(RuntimeError):
        run_increment(scan, fail, state, "job", default=4)
    assert state.read("job") is None
    taken = []
    assert run_increment(scan, lambda df: taken.extend(r.id for r in df.collect()), state, "job", default=4) == 9
    assert sorted(taken) == [5, 6, 7, 8, 9]
    taken.clear()
    run_increment(scan, lambda df: taken.extend(r.id for r in df.collect()), state, "job", default=4)
    assert taken == []
    run_increment(scan, lambda df: taken.extend(r.id for r in df.collect()), state, "job", default=-1, from_first=True)
    assert len(taken) == 10


def test_events_as_stream_keep_all_windows(spark, sf_dir, tmp_path):
    from tidemark.plans.scan_queries import stream_of

    stream = stream_key_time_metric(stream_of(spark, sf_dir, "events"), "event_type", "ts", "minute", "1 hour")
    drain(write_updates(stream, str(tmp_path / "o"), str(tmp_path / "c")))
    got = latest_counts(spark, str(tmp_path / "o"), ["metric", "data_time"], stream.schema)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert got.agg(F.sum("count")).first()[0] == events.count()


def test_several_metrics_of_a_stream_equal_their_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(4):
        write(spark, path, [(j, None if j % 7 == 0 else f"k{j % 3}", at(i * 200 + j)) for j in range(60)])
    specs = [
        MetricSpec("week", "k", "week"), MetricSpec("all", "k"),
        MetricSpec("late_day", "id", "day", time=F.col("ts") + F.expr("INTERVAL 5 HOURS"), where=F.col("k") != "k1"),
    ]
    records = spark.read.parquet(path)
    stream = stream_multi_metric(file_stream(spark, path, records.schema, max_files=1), specs, "ts", delay="60 days")
    drain(write_updates(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    got = latest_metrics(spark, str(tmp_path / "out"), specs, stream.schema)
    assert set(map(tuple, got.collect())) == set(map(tuple, multi_metric(records, specs, "ts").select(*got.columns).collect()))


def test_stream_metrics_are_counts_of_fixed_units(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [(1, "a", at(0))])
    sdf = file_stream(spark, path, spark.read.parquet(path).schema)
    with pytest.raises(ValueError, match="Mergeable"):
        stream_multi_metric(sdf, [MetricSpec("m", "k", "day", aggs={"s": F.sum("id")})], "ts")
    with pytest.raises(ValueError, match="unit"):
        stream_multi_metric(sdf, [MetricSpec("m", "k", "day")], "ts", unit="week")
    with pytest.raises(ValueError, match="no time"):
        stream_multi_metric(sdf, [MetricSpec("m", "k", "day")])


def folders(path):
    return sorted(int(p.name.split("-")[1]) for p in path.iterdir() if p.name.startswith("batch-"))


def test_stored_updates_are_compacted(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(8):
        write(spark, path, [(i * 10 + j, f"k{j % 3}", at(i)) for j in range(10)])
    stream = stream_key_time_metric(file_stream(spark, path, spark.read.parquet(path).schema, max_files=1), "k", "ts", "day", "10 days")
    drain(write_updates(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), every=3))
    # Batch 6 holds all before it, and batch 7 has removed them.
    assert folders(tmp_path / "out") == [6, *range(7, max(folders(tmp_path / "out")) + 1)]
    got = latest_counts(spark, str(tmp_path / "out"), ["metric", "data_time"], stream.schema)
    assert rows(got) == [("k0", at(0), 32), ("k1", at(0), 24), ("k2", at(0), 24)]


def add_up(df):
    return df.groupBy("k").agg(F.sum("count").alias("count"))


@pytest.mark.parametrize("replay", [False, True])
def test_stored_partials_are_right_after_any_number_of_batches(spark, tmp_path, replay):
    out, schema = str(tmp_path / "out"), spark.createDataFrame([], "k string, count bigint").schema
    assert rows(stored_partials(spark, out, schema, add_up)) == []
    for batch in range(3 * 3 + 1):
        for _ in range(1 + replay):
            store_batch(spark.createDataFrame([("a", 2**batch), (None, 1)], schema), out, batch, add_up, every=3)
            assert rows(stored_partials(spark, out, schema, add_up)) == [("a", 2**(batch + 1) - 1), (None, batch + 1)]
    assert len(folders(tmp_path / "out")) <= 2 * 3
    with pytest.raises(ValueError, match="another run"):
        store_batch(spark.createDataFrame([("a", 1)], schema), out, 0, add_up, every=3)


def test_a_batch_that_fails_while_it_takes_others_in_loses_nothing(spark, tmp_path):
    out, schema = str(tmp_path / "out"), spark.createDataFrame([], "k string, count bigint").schema
    for batch in range(2):
        store_batch(spark.createDataFrame([("a", 10**batch)], schema), out, batch, add_up, every=2)

    def broken(df):
        return df.withColumn("k", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        store_batch(spark.createDataFrame([("a", 100)], schema), out, 2, broken, every=2)
    assert rows(stored_partials(spark, out, schema, add_up)) == [("a", 11)]
    store_batch(spark.createDataFrame([("a", 100)], schema), out, 2, add_up, every=2)
    assert rows(stored_partials(spark, out, schema, add_up)) == [("a", 111)]


@pytest.mark.parametrize("files", [2, 3, 4, 5, 6])
def test_counts_of_a_job_and_of_behaviour_when_the_last_batch_takes_in_others(spark, tmp_path, files):
    path = str(tmp_path / "in")
    for i in range(files):
        write(spark, path, [(i * 100 + j, f"k{j % 3}", at(i)) for j in range(100)])
    stream = file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    job = Job(metrics=[MetricSpec("all", "k"), MetricSpec("day", "k", "day")], time="ts")
    drain(job.stream(stream, lambda n: [], str(tmp_path / "job"), str(tmp_path / "c1"), every=2))
    schema = T.StructType.fromDDL("metric_type string, metric string, data_time timestamp_ntz, count bigint")
    found = stored_partials(spark, str(tmp_path / "job"), schema, jobs.add_up)
    assert rows(found.groupBy("metric_type").agg(F.sum("count"))) == [("all", files * 100), ("day", files * 100)]

    def words(df):
        text = df.withColumns({"word": F.concat("k", (F.col("id") % 7).cast("string")), "kind": F.lit(SEARCH_EVENT), "made": F.col("ts")})
        return behaviour_words(text, ["id"], "k", "ts", "kind", "word", "word", "made", "made")

    drain(store_partials(stream, words, merge_behaviour_words, str(tmp_path / "words"), str(tmp_path / "c2"), every=2))
    stored = stored_partials(spark, str(tmp_path / "words"), words(spark.read.parquet(path)).schema, merge_behaviour_words)
    assert rows(behaviour_days(stored)) == rows(behaviour_days(words(spark.read.parquet(path))))


def test_partials_of_an_empty_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [])
    schema = spark.read.parquet(path).schema

    def count(df):
        return df.groupBy("k").agg(F.count("*").alias("count"))

    query = store_partials(file_stream(spark, path, schema), count, lambda df: df, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    drain(query)
    assert not query.exception()


@pytest.mark.parametrize("name", ["W1_stream_key_time_metric", "W2_flush_open_windows", "W1_stream_month_metric"])
def test_no_row_of_a_table_is_late_in_several_batches(spark, sf_dir, tmp_path, monkeypatch, name):
    """The same rows, the newest files first and one file for each batch."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy(F.col("ts").desc()).collect()
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    for i in range(4):
        part = table[len(table) * i // 4:len(table) * (i + 1) // 4]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(scan_queries, "file_stream", lambda *how, **more: file_stream(*how, **more | {"max_files": 1}))
    assert differences(spark, connect(sf_dir), QUERIES[name].run, QUERIES[name].sql, str(tmp_path)) is None


def test_aggregates_of_a_streamed_job_equal_their_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(5):
        write(spark, path, [(j * (i + 1), None if j % 7 == 0 else f"k{j % 3}", at(i * 10 + (j * 5 % 13))) for j in range(40)])
    specs = [
        MetricSpec("day", "k", "day", aggs={"sum": total_of("id"), "mean": mean_of(F.when(F.col("k") != "k1", F.col("id")))}, first={"first": "id"}, order=["ts", "id"]),
        MetricSpec("all", "k", aggs={"most": greatest_of("id"), "even": count_of(F.col("id") % 2 == 0)}),
    ]
    records = spark.read.parquet(path)
    job = Job(metrics=specs, time="ts")
    drain(job.stream(file_stream(spark, path, records.schema, max_files=1), lambda n: [], str(tmp_path / "m"), str(tmp_path / "c"), every=2))
    got = job.stored_metrics(records, str(tmp_path / "m"))
    whole = multi_metric(records, specs, "ts")
    assert sorted(got.columns) == sorted(whole.columns)
    assert rows(got.select(*whole.columns)) == rows(whole)
    assert got.where("metric_type = 'day' and sum is not null and first is not null").count() > 3
