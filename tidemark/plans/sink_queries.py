"""Queries for sinks and streams. Each writes to the shared folder and reads back."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.changes import apply_changes
from tidemark.operators.lookups import lookup_as_of
from tidemark.operators.metrics import (
    MetricSpec, behaviour_days, behaviour_words, count_of, first_of, key_time_metric, least_of, mean_of, merge_behaviour_words, merge_partials, multi_metric,
    roll_up, total_of, with_labels,
)
from tidemark.operators.transforms import with_temp
from tidemark.plans.change_queries import old_orders
from tidemark.plans.jobs import Job, add_up
from tidemark.plans.metric_queries import BEHAVIOUR, BEHAVIOUR_SQL, LABELS_SQL, LOG_METRICS, LOG_METRICS_SQL, behaviour_rows, bucketed
from tidemark.plans.registry import CHANGES_SQL, order_changes, query, table
from tidemark.plans.scan_queries import stream_of
from tidemark.session import shared_folder
from tidemark.sinks import records as rec
from tidemark.sinks import tables as tb
from tidemark.sinks.batches import stored_rows
from tidemark.sinks.buckets import BucketTable, stream_into
from tidemark.sources.records import change_feed
from tidemark.sources.state import StateTable
from tidemark.sources.tables import incremental_scan
from tidemark.streaming import (
    EndMarks,
    closed_rows,
    file_stream,
    latest_counts,
    latest_metrics,
    run_increment,
    store_partials,
    stored_partials,
    stream_apply,
    stream_checked,
    stream_counts,
    stream_fan_out,
    stream_key_metric,
    stream_key_time_metric,
    stream_lookup_as_of,
    stream_multi_metric,
    write_closed,
    write_updates,
)
from tidemark.streaming.handover import end_history, history_then_live
from tidemark.streaming.state import stream_behaviour


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def read_like(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("K1_table_append", "SELECT event_id, value FROM events UNION ALL SELECT event_id, value FROM events")
def appended(spark, sf_dir):
    rows, path = events(spark, sf_dir).select("event_id", "value"), shared_folder(spark, "append")
    tb.table_append(rows, path)
    tb.table_append(rows, path)
    return read_like(rows, path)


@query("K4_with_id", """
SELECT event_id, sha256(event_id || chr(1) || event_type) AS _id, 36 AS random_length, (SELECT count(*) FROM events) AS distinct_ids
FROM events""")
def ids(spark, sf_dir):
    rows = rec.with_id(events(spark, sf_dir).select("event_id", "event_type"))
    random = rec.with_id(rows, name="_random", random=True).withColumn("random_length", F.length("_random"))
    total = rows.agg(F.count_distinct("_id")).scalar()
    return random.select("event_id", "_id", "random_length", total.alias("distinct_ids"))


@query("K5_target_name", """
SELECT 'cityperson-' || strftime(ts, '%Y.%m.%d') || '-v1' AS _target, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1""")
def routed(spark, sf_dir):
    name = tb.target_name("cityperson-{dateformat=yyyy.MM.dd}-v1", F.col("ts"))
    rows, path = events(spark, sf_dir).withColumn("_target", name), shared_folder(spark, "routed")
    tb.write_routed(rows, path)
    return read_like(rows, path).groupBy("_target").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("K6_route_by_file", """
SELECT CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'others' END AS _target, count(*) AS n FROM events GROUP BY 1""")
def by_file(spark, sf_dir):
    """Records in one folder per event type, routed by the file they were read from."""
    rows, path = events(spark, sf_dir), shared_folder(spark, "by-file")
    rows.withColumn("kind", F.col("event_type")).hint("rebalance", "kind").write.partitionBy("kind").parquet(path)
    source = F.regexp_extract(F.col("_metadata.file_path"), r"kind=([^/]+)/", 1)
    read = read_like(rows, path).withColumn("file", F.concat(source, F.lit(".txt")))
    out = tb.route_by_file(read, "file", {"click.txt": "clicks", "view.txt": "views"}, "others")
    return out.groupBy("_target").agg(F.count("*").alias("n"))


@query("K7_fan_out", """
SELECT 'all' AS sink, count(*) AS n, round(sum(value), 2) AS total FROM events
UNION ALL SELECT 'errors', count(*), round(sum(value), 2) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'first', count(*), round(sum(value), 2) FROM (
  SELECT value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 3)
UNION ALL SELECT 'messages', count(*), NULL FROM events""")
def several_outputs(spark, sf_dir):
    path = shared_folder(spark, "fan-out")
    rows = events(spark, sf_dir)

    def to(name: str):
        return lambda df: tb.overwrite(df, f"{path}/{name}")

    tb.fan_out(rows, [
        tb.Sink("all", to("all")),
        tb.Sink("errors", to("errors"), filter=F.col("event_type") == "error"),
        tb.Sink("first", to("first"), limit=3, order=["event_id"], batch="event_type"),
        tb.Sink("messages", to("messages"), transform=lambda df: rec.encode_messages(df, "event_id", "events")),
        tb.Sink("nothing", tb.noop_sink),
    ])

    def written(name: str) -> DataFrame:
        found = read_like(rows, f"{path}/{name}")
        return found.agg(F.lit(name).alias("sink"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))

    messages = spark.read.schema("key binary, value binary, topic string").parquet(f"{path}/messages")
    sent = messages.agg(F.lit("messages").alias("sink"), F.count("value").alias("n"), F.lit(None).cast("double").alias("total"))
    return written("all").unionByName(written("errors")).unionByName(written("first")).unionByName(sent)


@query("K8_output_filter", "SELECT event_id, value FROM events WHERE value > 50")
def output_filter(spark, sf_dir):
    sink = tb.Sink("large", tb.noop_sink, filter=F.col("value") > 50)
    return sink.frame(events(spark, sf_dir).select("event_id", "value"))


@query("K9_rolling_files", """
SELECT file_seq, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (
  SELECT event_id, lpad(CAST((row_number() OVER (ORDER BY event_id) - 1) // 2000 + 1 AS VARCHAR), 6, '0') AS file_seq FROM events)
GROUP BY file_seq""")
def rolled(spark, sf_dir):
    path = shared_folder(spark, "rolling")
    rows = events(spark, sf_dir).select("event_id", "event_type")
    tb.rolling_write(rows, path, 2000, "20240201", ["event_id"])
    schema = "event_id bigint, event_type string, run string, file_seq string"
    read = spark.read.schema(schema).json(path)
    return read.groupBy("file_seq").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("K10_delimited_record", """
SELECT doc_id, md5(doc_id || '|' || coalesce(nullif(lang, 'en'), '') || '|' || replace(text, '|', '__') || '|' || source) AS record
FROM documents""")
def delimited(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))
    lines = rec.delimited_record(docs, ["doc_id", "lang", "text", "source"], "|", escape=["text"], keep=["doc_id"])
    return lines.select("doc_id", F.md5(F.col("value").cast("binary")).alias("record"))


@query("K11_json_record", """
SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def json_lines(spark, sf_dir):
    path = shared_folder(spark, "json")
    rec.json_record(events(spark, sf_dir).select("event_id", "user_id", "event_type")).write.text(path)
    return spark.read.text(path)


@query("K12_encode_messages", """
SELECT CAST(event_id AS VARCHAR) AS key, event_type AS topic, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
FROM events""")
def encoded(spark, sf_dir):
    sent = rec.encode_messages(events(spark, sf_dir), "event_id", F.col("event_type"), ["user_id", "event_type"])
    return sent.select(F.col("key").cast("string").alias("key"), "topic", F.col("value").cast("string").alias("value"))


@query("K13_envelope", """
WITH rows AS (
  SELECT (row_number() OVER (ORDER BY event_id) - 1) // 500 AS batch_no, event_id,
         '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS r FROM events),
batches AS (SELECT batch_no, count(*) AS records, '[' || string_agg(r, ',' ORDER BY event_id) || ']' AS datas FROM rows GROUP BY batch_no)
SELECT batch_no, records, md5(datas) AS signature,
       md5('{"device_id":"unit-7","app_id":"shop-2","datas":' || datas || ',"signature":"' || md5(datas) || '"}') AS body FROM batches""")
def enveloped(spark, sf_dir):
    constants = {"device_id": "unit-7", "app_id": "shop-2"}
    out = rec.envelope(events(spark, sf_dir), ["event_id"], 500, constants, ["event_id", "event_type"])
    return out.withColumn("body", F.md5(F.col("body").cast("binary")))


@query("K14_custom_sink", "SELECT count(*) AS records, CAST(sum(event_id) AS BIGINT) AS ids FROM events")
def called_back(spark, sf_dir):
    """The callback runs in the tasks and gets lists of records; here it adds them up."""
    records, ids = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def add(batch: list[dict], context: dict) -> None:
        records.add(len(batch))
        ids.add(sum(r[context["field"]] for r in batch))

    tb.custom_sink(events(spark, sf_dir).select("event_id"), add, 500, {"field": "event_id"})
    return spark.createDataFrame([(records.value, ids.value)], "records bigint, ids bigint")


@query("K15_noop", "SELECT count(*) AS n FROM events")
def nothing_written(spark, sf_dir):
    rows = events(spark, sf_dir)
    tb.noop_sink(rows)
    return rows.agg(F.count("*").alias("n"))


@query("K16_overwrite", "SELECT event_id FROM events WHERE event_type = 'view'")
def replaced(spark, sf_dir):
    path = shared_folder(spark, "overwrite")
    rows = events(spark, sf_dir).select("event_id", "event_type")
    tb.overwrite(rows, path)
    tb.overwrite(rows.filter("event_type = 'view'"), path)
    return read_like(rows, path).select("event_id")


@query("K17_labelled_export", """
SELECT CAST(event_id AS VARCHAR) AS "Number", event_type AS "Operation module" FROM events""")
def exported(spark, sf_dir):
    path = shared_folder(spark, "export")
    tb.labelled_export(events(spark, sf_dir), path, [("event_type", "Operation module"), ("event_id", "Number")])
    return spark.read.option("header", True).csv(path)


@query("K18_write_metrics", f"""
SELECT metric AS name, data_time, count, {LABELS_SQL},
       metric_type AS source
FROM ({LOG_METRICS_SQL})""")
def metric_tables(spark, sf_dir):
    path = shared_folder(spark, "metrics")
    rows = multi_metric(events(spark, sf_dir), LOG_METRICS, "ts", ("year", "month", "week", "day", "hour", "minute"))
    fields = {"module": {"metric": "operModule"}, "user": {"metric": "logUser"}}
    tb.write_metrics(rows, path, {"module": "module", "user": "user"}, fields)

    def read(target: str, key: str) -> DataFrame:
        schema = rows.drop("metric_type").withColumnRenamed("metric", key).schema
        return spark.read.schema(schema).parquet(f"{path}/{target}").withColumnRenamed(key, "name").withColumn("source", F.lit(target))

    return read("module", "operModule").unionByName(read("user", "logUser"))


@query("A17_job_outputs", f"""
SELECT 'detail' AS part, event_type AS metric, NULL AS data_time, count(*) AS count FROM events GROUP BY 2
UNION ALL SELECT 'metrics', * FROM ({bucketed('event_type', 'month')})""")
def whole_job(spark, sf_dir):
    path = shared_folder(spark, "job")
    job = Job(
        transforms=[lambda df: df.select("event_id", "event_type", "ts")],
        outputs=[tb.Sink("detail", lambda df: tb.overwrite(df, f"{path}/detail"))],
        metrics=[MetricSpec("module", "event_type", "month")],
        metric_sink=lambda df: tb.overwrite(df, f"{path}/metrics"),
        time="ts", labels=(),
    )
    job.run(events(spark, sf_dir))
    detail = spark.read.schema("event_id bigint, event_type string, ts timestamp_ntz").parquet(f"{path}/detail")
    per_type = detail.groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("count"))
    metrics = spark.read.schema("metric string, data_time timestamp_ntz, count bigint").parquet(f"{path}/metrics")
    nothing = F.lit(None).cast("timestamp_ntz")
    return per_type.select(F.lit("detail").alias("part"), "metric", nothing.alias("data_time"), "count").unionByName(
        metrics.withColumn("part", F.lit("metrics"))
    )


def streamed_counts(spark: SparkSession, stream: DataFrame, keys: list[str]) -> DataFrame:
    path, checkpoint = shared_folder(spark, "updates"), shared_folder(spark, "checkpoint")
    write_updates(stream, path, checkpoint).awaitTermination()
    return latest_counts(spark, path, keys, stream.schema)


def streamed_windows(spark: SparkSession, sf_dir: str, key: str, window_type: str) -> DataFrame:
    """Counts by key and window over all files of a table, in whatever order they come: no row is too late."""
    path, checkpoint = shared_folder(spark, "partials"), shared_folder(spark, "checkpoint")
    stream = stream_of(spark, sf_dir, "events")

    def counts(rows: DataFrame) -> DataFrame:
        return key_time_metric(rows, key, "ts", window_type, labels=())

    def merged(partials: DataFrame) -> DataFrame:
        return merge_partials(partials, ["metric", "data_time"])

    store_partials(stream, counts, merged, path, checkpoint).awaitTermination()
    return stored_partials(spark, path, counts(stream).schema, merged)


@query("W1_stream_backfill", bucketed("event_type", "day"))
def streamed_backfill(spark, sf_dir):
    """A table read as a stream from its beginning, whose files come in any order of time."""
    return streamed_windows(spark, sf_dir, "event_type", "day")


# How long the streams in order of time wait for late rows.
DELAY_S = 100


def arriving_in_order(spark: SparkSession, rows: DataFrame, source: str, runs: int) -> Iterator[datetime]:
    """Write the rows of one part of time after the other; before each next part the caller runs the stream."""
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / runs
    for i in range(runs):
        after = F.lit(True) if i == 0 else F.col("ts") >= F.lit(first + i * step)
        before = F.lit(True) if i == runs - 1 else F.col("ts") < F.lit(first + (i + 1) * step)
        rows.where(after & before).write.mode("append").parquet(source)
        yield last


def in_order_of_time(spark: SparkSession, sf_dir: str, key: str, window_type: str) -> DataFrame:
    """Counts by key and window of two runs in order of time: what comes later than the watermark is dropped, here nothing."""
    rows = events(spark, sf_dir)
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "updates"), shared_folder(spark, "checkpoint")
    for _ in arriving_in_order(spark, rows, source, 2):
        stream = stream_key_time_metric(file_stream(spark, source, rows.schema), key, "ts", window_type, f"{DELAY_S} seconds")
        write_updates(stream, path, checkpoint).awaitTermination()
    return latest_counts(spark, path, ["metric", "data_time"], stream.schema)


@query("W1_stream_key_time_metric", f"SELECT *, {LABELS_SQL} FROM ({bucketed('event_type', 'day')})")
def streamed_days(spark, sf_dir):
    return with_labels(in_order_of_time(spark, sf_dir, "event_type", "day"))


@query("W1_stream_month_metric", bucketed("event_type", "month"))
def streamed_months(spark, sf_dir):
    """Streamed by day, rolled up to months."""
    return roll_up(in_order_of_time(spark, sf_dir, "event_type", "day"), "month")


def closed_and_flushed(spark: SparkSession, rows: DataFrame, time: str, window_s: int, closing) -> DataFrame:
    """What a stream in append mode gives out over two runs in order of time, and then (``flushed``) at its end."""
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "closed"), shared_folder(spark, "checkpoint")
    marks = EndMarks(spark, shared_folder(spark, "marks"))

    def run() -> DataFrame:
        stream = closing(marks.attach(file_stream(spark, source, rows.schema), time))
        write_closed(stream, path, checkpoint).awaitTermination()
        return closed_rows(spark, path, stream.schema)

    for newest in arriving_in_order(spark, rows, source, 2):
        before = run()
    last = before.agg(F.max("batch_id")).first()[0]
    marks.put(newest, window_s, DELAY_S)
    return run().withColumn("flushed", F.col("batch_id") > F.lit(-1 if last is None else last)).drop("batch_id")


@query("W2_flush_open_windows", f"""
SELECT *, data_time + INTERVAL 1 HOUR > (SELECT max(ts) - INTERVAL {DELAY_S} SECOND FROM events) AS flushed
FROM ({bucketed("CAST(user_id AS VARCHAR)", "hour")})""")
def streamed_hours(spark, sf_dir):
    """Closed hours as the watermark passes them; those still open at the end come by the flush."""
    return closed_and_flushed(
        spark, events(spark, sf_dir), "ts", 3600, lambda sdf: stream_key_time_metric(sdf, "user_id", "ts", "hour", f"{DELAY_S} seconds")
    )


@query("A9_stream_state", BEHAVIOUR_SQL)
def behaviour_state(spark, sf_dir):
    """A user's day kept as state, given out when the day is over and, for the last day, at the end of the stream."""
    # The watermark follows the ends of days, so the mark is put a day and the delay behind the newest one.
    found = closed_and_flushed(
        spark, behaviour_rows(spark, sf_dir), "ts", 24 * 3600, lambda sdf: stream_behaviour(sdf, delay=f"{DELAY_S} seconds", **BEHAVIOUR)
    )
    return found.drop("flushed")


@query("W1_stream_multi_metric", f"""
SELECT 'type_by_week' AS metric_type, * FROM ({bucketed('event_type', 'week')})
UNION ALL SELECT 'user_by_month', CAST(user_id AS VARCHAR), date_trunc('month', ts + INTERVAL 36 HOUR), count(*)
FROM events WHERE event_type <> 'error' GROUP BY 2, 3
UNION ALL SELECT 'type', event_type, NULL, count(*) FROM events GROUP BY 2""")
def streamed_metrics(spark, sf_dir):
    """Metrics with own keys, times, filters and windows over one stream, with a restart in between."""
    specs = [
        MetricSpec("type_by_week", "event_type", "week"),
        MetricSpec("user_by_month", "user_id", "month", time=F.col("ts") + F.expr("INTERVAL 36 HOURS"), where=F.col("event_type") != "error"),
        MetricSpec("type", "event_type"),
    ]

    def counts(rows: DataFrame) -> DataFrame:
        # The second files hold older rows too: nothing is to be late here.
        return stream_multi_metric(rows, specs, "ts", delay="36500 days")

    path, schema = in_two_runs(spark, events(spark, sf_dir), F.col("event_id") % 2 == 1, counts)
    return latest_metrics(spark, path, specs, schema)


@query("W1_stream_aggregates", """
SELECT 'type_by_month' AS metric_type, event_type AS metric, date_trunc('month', ts) AS data_time, count(*) AS count,
       sum(user_id)::BIGINT AS users, min(ts) AS earliest, arg_min(event_id, (ts, event_id)) AS first_event, NULL::BIGINT AS high, NULL::DOUBLE AS mean_user
FROM events GROUP BY 2, 3
UNION ALL SELECT 'user_by_day', CAST(user_id AS VARCHAR), date_trunc('day', ts), count(*), NULL, min(ts), NULL,
       count(*) FILTER (value > 50), round(avg(user_id), 6)
FROM events WHERE event_type <> 'error' GROUP BY 2, 3""")
def streamed_aggregates(spark, sf_dir):
    """Sums, minima, first records, conditions and means of two metrics, by day under a watermark in three runs in order of time."""
    rows = events(spark, sf_dir)
    specs = [
        MetricSpec("type_by_month", "event_type", "month", aggs={
            "users": total_of("user_id"), "earliest": least_of("ts"), "first_event": first_of("event_id", "ts", "event_id"),
        }),
        MetricSpec("user_by_day", "user_id", "day", where=F.col("event_type") != "error", aggs={
            "earliest": least_of("ts"), "high": count_of(F.col("value") > 50), "mean_user": mean_of("user_id"),
        }),
    ]
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "updates"), shared_folder(spark, "checkpoint")
    for _ in arriving_in_order(spark, rows, source, 3):
        stream = stream_multi_metric(file_stream(spark, source, rows.schema), specs, "ts", delay=f"{DELAY_S} seconds")
        write_updates(stream, path, checkpoint).awaitTermination()
    return latest_metrics(spark, path, specs, stream.schema).withColumn("mean_user", F.round("mean_user", 6))


@query("W1_stream_behaviour", BEHAVIOUR_SQL)
def streamed_behaviour(spark, sf_dir):
    """A user's day in two runs: its words come in parts, which every second batch puts together."""
    rows = behaviour_rows(spark, sf_dir)
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "words"), shared_folder(spark, "checkpoint")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        rows.where(part).repartition(2).write.mode("append").parquet(source)
        stream = file_stream(spark, source, rows.schema, max_files=1)
        store_partials(stream, lambda df: behaviour_words(df, **BEHAVIOUR), merge_behaviour_words, path, checkpoint, every=2).awaitTermination()
    schema = behaviour_words(rows, **BEHAVIOUR).schema
    return behaviour_days(stored_partials(spark, path, schema, merge_behaviour_words))


@query("A17_stream_job", f"""
SELECT 'detail' AS metric_type, event_type AS metric, NULL AS data_time, count(*) AS count FROM events GROUP BY 2
UNION ALL SELECT 'by_month', * FROM ({bucketed('event_type', 'month')})
UNION ALL SELECT 'by_user', CAST(user_id AS VARCHAR), NULL, count(*) FROM events GROUP BY 2""")
def streamed_job(spark, sf_dir):
    """Detail records and metrics out of the same micro-batches, in two runs."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    job = Job(
        transforms=[lambda df: with_temp(df, kind=F.col("event_type"))],
        metrics=[MetricSpec("by_month", "_tmp_kind", "month"), MetricSpec("by_user", "user_id")], time="ts",
    )
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "job"), shared_folder(spark, "checkpoint")

    def outputs(batch_id: int) -> list[tb.Sink]:
        return [tb.Sink("detail", lambda df: tb.overwrite(df, f"{path}/detail/batch_id={batch_id}"))]

    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        rows.where(part).repartition(2).write.mode("append").parquet(source)
        job.stream(file_stream(spark, source, rows.schema, max_files=1), outputs, f"{path}/metrics", checkpoint, every=2).awaitTermination()
    detail = spark.read.schema(rows.schema).parquet(f"{path}/detail")
    nothing = F.lit(None).cast("timestamp_ntz")
    per_type = detail.groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("count"))
    schema = T.StructType.fromDDL("metric_type string, metric string, data_time timestamp_ntz, count bigint")
    return stored_partials(spark, f"{path}/metrics", schema, add_up).unionByName(
        per_type.withColumns({"metric_type": F.lit("detail"), "data_time": nothing})
    )


LATE_CUT = "SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events"


@query("W1_late_rows", f"""
WITH parts AS (SELECT *, ts >= ({LATE_CUT}) OR event_id % 10 = 0 AS second FROM events),
     mark AS (SELECT max(ts) - INTERVAL 100 SECOND AS m FROM parts WHERE NOT second)
SELECT event_type AS metric, date_trunc('day', ts) AS data_time, count(*) AS count FROM parts
WHERE NOT second OR date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT m FROM mark) GROUP BY 1, 2""")
def late_days(spark, sf_dir):
    """The second run brings newer rows, and old ones that come behind the watermark: those are dropped."""
    rows = events(spark, sf_dir)
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    late = (F.col("ts") >= F.lit(first + (last - first) / 2)) | (F.col("event_id") % 10 == 0)
    path, schema = in_two_runs(spark, rows, late, lambda sdf: stream_key_time_metric(sdf, "event_type", "ts", "day", "100 seconds"))
    return latest_counts(spark, path, ["metric", "data_time"], schema)


def in_two_runs(spark: SparkSession, rows: DataFrame, second, counts) -> tuple[str, T.StructType]:
    """Write some files, run the stream, write the files of the ``second`` rows, run it again: updates and their schema."""
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "updates"), shared_folder(spark, "checkpoint")
    for part in (~second, second):
        rows.where(part).write.mode("append").parquet(source)
        stream = counts(file_stream(spark, source, rows.schema))
        write_updates(stream, path, checkpoint).awaitTermination()
    return path, stream.schema


@query("W4_restart", """
SELECT CAST(0 AS BIGINT) AS batch_id, event_type AS metric, count(*) AS count FROM events WHERE event_id % 2 = 0 GROUP BY 2
UNION ALL SELECT 1, event_type, count(*) FROM events GROUP BY 2 HAVING count(*) FILTER (event_id % 2 = 1) > 0""")
def restarted(spark, sf_dir):
    """What each run wrote: the second goes on at the checkpoint, with files that came in between."""
    path, schema = in_two_runs(spark, events(spark, sf_dir), F.col("event_id") % 2 == 1, lambda sdf: stream_key_metric(sdf, "event_type"))
    return stored_rows(spark, path, schema)


@query("W5_periodic_increment", "SELECT 0 AS run, max(event_id) AS mark, count(*) AS n FROM events")
def periodic(spark, sf_dir):
    """The same job three times: the first run takes everything, the others nothing."""
    rows, out = events(spark, sf_dir).select("event_id", "ts"), shared_folder(spark, "periodic")
    state = StateTable(spark, shared_folder(spark, "state"))
    for run in range(3):
        run_increment(
            lambda last: incremental_scan(rows, "event_id", last),
            lambda found, run=run: found.write.parquet(f"{out}/run={run}"), state, "periodic",
        )
    read = spark.read.schema("event_id bigint, ts timestamp_ntz, run int").parquet(out)
    return read.groupBy("run").agg(F.max("event_id").alias("mark"), F.count("*").alias("n"))


@query("W6_stream_key_metric", "SELECT event_type AS metric, count(*) AS count FROM events GROUP BY 1")
def streamed_keys(spark, sf_dir):
    return streamed_counts(spark, stream_key_metric(stream_of(spark, sf_dir, "events"), "event_type"), ["metric"])


@query("W7_bucket_table", """
SELECT o_orderkey, o_custkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS price
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT -1 - c_custkey, c_custkey, round(c_acctbal, 2) FROM customer""")
def bucket_table(spark, sf_dir):
    """A change feed in three parts, streamed into a table of hash buckets that is merged when it is read."""
    feed_path, checkpoint = shared_folder(spark, "feed"), shared_folder(spark, "checkpoint")
    old = old_orders(spark, sf_dir)
    buckets = BucketTable(spark, shared_folder(spark, "buckets"), old.schema, ["o_orderkey"], buckets=16, most_deltas=2)
    buckets.load(old)
    shop = change_feed(order_changes(spark, sf_dir), ["shop.orders"])
    # Inserts come last: their seq is that of the first change of a key.
    for op in ("D", "U", "I"):
        shop.where(F.col("op") == op).write.mode("append").parquet(feed_path)
        stream_into(file_stream(spark, feed_path, shop.schema), buckets, checkpoint, "feed").awaitTermination()
    return buckets.read().withColumn("price", F.round("price", 2))


@query("W7_stream_apply", """
SELECT o_orderkey, o_custkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS price
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT -1 - c_custkey, c_custkey, round(c_acctbal, 2) FROM customer""")
def streamed_changes(spark, sf_dir):
    """A change feed, written as files, applied to its target as a stream."""
    feed_path, path = shared_folder(spark, "feed"), shared_folder(spark, "applied")
    shop = change_feed(order_changes(spark, sf_dir), ["shop.orders"])
    shop.write.parquet(feed_path)
    stream = spark.readStream.schema(shop.schema).option("maxFilesPerTrigger", 64).parquet(feed_path)
    stream_apply(stream, path, ["o_orderkey"], shared_folder(spark, "checkpoint")).awaitTermination()
    stored = tb.read_changes(spark, path, "op string, seq bigint, o_orderkey bigint, o_custkey bigint, price double")
    out = apply_changes(old_orders(spark, sf_dir), stored.drop("batch_id"), ["o_orderkey"])
    return out.withColumn("price", F.round("price", 2))


@query("W3_stream_fan_out", " UNION ALL ".join(f"""
SELECT '{sink}' AS sink, CAST({batch} AS BIGINT) AS batch_id, count(*) AS n FROM events WHERE event_id % 2 = {batch} AND {condition}"""
    for sink, condition in (("all", "true"), ("errors", "event_type = 'error'")) for batch in (0, 1)))
def streamed_outputs(spark, sf_dir):
    """Two runs with files in between: each takes the new files only, as one batch to all outputs."""
    rows = events(spark, sf_dir).select("event_id", "event_type")
    source, path, checkpoint = shared_folder(spark, "arriving"), shared_folder(spark, "stream-out"), shared_folder(spark, "checkpoint")

    def sinks(batch_id: int) -> list[tb.Sink]:
        def to(name: str):
            return lambda df: tb.overwrite(df, f"{path}/{name}/batch_id={batch_id}")

        return [tb.Sink("all", to("all")), tb.Sink("errors", to("errors"), filter=F.col("event_type") == "error")]

    for odd in (0, 1):
        rows.where(F.col("event_id") % 2 == odd).write.mode("append").parquet(source)
        stream_fan_out(file_stream(spark, source, rows.schema), sinks, checkpoint).awaitTermination()

    def count(name: str) -> DataFrame:
        found = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(f"{path}/{name}")
        return found.groupBy("batch_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("sink"), "batch_id", "n")

    return count("all").unionByName(count("errors"))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a user as versions of it, each valid from its date."""
    orders = table(spark, sf_dir, "orders")
    # Order dates brought into the month of the events, at the hour that their key gives.
    since = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.dayofmonth("o_orderdate"), (F.col("o_orderkey") % 24).cast("int"), F.lit(0), F.lit(0))
    return orders.select((F.col("o_custkey") % 150).alias("user_id"), since.alias("since"), "o_orderkey")


AS_OF_SQL = """
WITH versions AS (
  SELECT o_custkey % 150 AS user_id, max(o_orderkey) AS o_orderkey,
         make_timestamp(2024, 1, day(o_orderdate), o_orderkey % 24, 0, 0) AS since
  FROM orders WHERE day(o_orderdate) <= 30 GROUP BY ALL
)
SELECT e.event_id, v.o_orderkey AS valid_order FROM events e ASOF LEFT JOIN versions v ON e.user_id = v.user_id AND e.ts >= v.since"""


@query("J1_lookup_as_of", AS_OF_SQL)
def as_of(spark, sf_dir):
    """Each event with the version of its user that was valid at its time."""
    versions = order_versions(spark, sf_dir).where(F.dayofmonth("since") <= 30)
    found = lookup_as_of(events(spark, sf_dir), versions, "user_id", "ts", "since", "version", ["o_orderkey"])
    return found.select("event_id", F.col("version.o_orderkey").alias("valid_order"))


@query("J1_stream_as_of", AS_OF_SQL)
def streamed_as_of(spark, sf_dir):
    """The same over a stream in two runs in order of time; the versions of the second half come in between."""
    rows, versions = events(spark, sf_dir), order_versions(spark, sf_dir).where(F.dayofmonth("since") <= 30)
    source, path, checkpoint, changes = (shared_folder(spark, n) for n in ("arriving", "found", "checkpoint", "versions"))
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(first + (last - first) / 2)

    def known() -> DataFrame:
        return spark.read.schema(versions.schema).parquet(changes)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("event_id", F.col("version.o_orderkey").alias("valid_order")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    for run, _ in enumerate(arriving_in_order(spark, rows, source, 2)):
        half = F.col("since") < middle if run == 0 else F.col("since") >= middle
        versions.where(half).write.mode("append").parquet(changes)
        stream_lookup_as_of(
            file_stream(spark, source, rows.schema), known, write, checkpoint, "user_id", "ts", "since", "version", ["o_orderkey"]
        ).awaitTermination()
    return spark.read.schema("event_id bigint, valid_order bigint").parquet(path).select("event_id", "valid_order")


@query("A15_stream_counters", """
SELECT 'count' AS part, count(*) AS total, count(*) FILTER (event_type <> 'error' AND value >= 10 AND user_id % 10 <> 0) AS success,
       count(*) FILTER (event_type = 'error' OR value < 10) AS failed,
       count(*) FILTER (event_type <> 'error' AND value >= 10 AND user_id % 10 = 0) AS ignored FROM events
UNION ALL SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'low' END, count(*), NULL, NULL, NULL FROM events WHERE event_type = 'error' OR value < 10 GROUP BY 1""")
def streamed_counters(spark, sf_dir):
    """Records checked in three runs: how many passed, failed and were left out, and the failed ones by reason."""
    rows = events(spark, sf_dir)
    source, good, bad, counts, checkpoint = (shared_folder(spark, n) for n in ("arriving", "good", "bad", "counts", "checkpoint"))

    def into(path: str):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    rules = [("error", F.col("event_type") == "error"), ("low", F.col("value") < 10)]
    for _ in arriving_in_order(spark, rows, source, 3):
        stream = file_stream(spark, source, rows.schema)
        stream_checked(stream, rules, into(good), into(bad), counts, checkpoint, F.col("user_id") % 10 == 0, every=2).awaitTermination()
    whole = stream_counts(spark, counts).select(F.lit("count").alias("part"), "*")
    reasons = spark.read.schema("reject_reason string").parquet(bad).groupBy(F.col("reject_reason").alias("part")).agg(F.count("*").alias("total"))
    return whole.unionByName(reasons, allowMissingColumns=True)


@query("S25_history_to_live", f"""
WITH {CHANGES_SQL}
SELECT op, seq, coalesce(a_key, b_key) AS o_orderkey FROM changes WHERE tbl = 'orders'""")
def handed_over(spark, sf_dir):
    """One stream over old changes and a live feed that starts before their end, with a restart within the overlap."""
    key = F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey")
    changes = change_feed(order_changes(spark, sf_dir), ["shop.orders"]).select("op", "seq", key, F.timestamp_seconds("seq").alias("at"))
    top = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] * 3
    old, live, path, checkpoint = (shared_folder(spark, n) for n in ("old", "live", "taken", "checkpoint"))
    marks = EndMarks(spark, shared_folder(spark, "marks"))
    seam = datetime.fromtimestamp(top // 4, UTC).replace(tzinfo=None)
    changes.where(F.col("seq") <= top // 2).write.parquet(old)
    # The first run ends within what both have; the second reads on, and the third follows the live feed alone.
    for low, high in ((top // 4, top // 3), (top // 3, 3 * top // 4), (3 * top // 4, top + 2)):
        changes.where((F.col("seq") >= low) & (F.col("seq") < high)).write.mode("append").parquet(live)
        both = history_then_live(
            file_stream(spark, old, changes.schema), file_stream(spark, live, changes.schema), ["op", "seq"], "at", seam, f"{top} seconds", marks
        )
        write_closed(both, path, checkpoint).awaitTermination()
        if low > top // 4:
            end_history(marks)
    return closed_rows(spark, path, both.schema).select("op", "seq", "o_orderkey")
