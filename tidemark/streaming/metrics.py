"""Metrics over streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import bucket
from tidemark.operators.metrics import UNKNOWN, MetricSpec, key_or_default, mergeable_of, merge_metrics
from tidemark.sinks.batches import store_batch, stored_rows
from tidemark.streaming.flush import without_marks
from tidemark.streaming.runs import trigger_options


# Micro-batches between two compactions of what a stream has stored.
COMPACT_EVERY = 64
METRIC_KEYS = ["metric_type", "metric", "data_time"]
# Windows of fixed length. Spark forgets them when the watermark has passed.
FIXED_WINDOWS = {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}


def stream_key_time_metric(sdf: DataFrame, key: Column | str, time: str, window_type: str, delay: str = "0 seconds",
                           default: str = UNKNOWN) -> DataFrame:
    """``metric``, ``data_time``, ``count`` by event time.

    ``delay`` is how long a window waits for late rows; rows later than that are
    dropped and counted (``late_rows``). Any output mode works: ``append`` gives
    closed windows, ``update`` running counts. For weeks, months and years,
    stream by day and ``roll_up`` what was written: the stream then never has
    to keep more than the open days. ``EndMarks`` attached to ``sdf`` give out the last windows.
    """
    if window_type not in FIXED_WINDOWS:
        raise ValueError(f"window_type must be one of {tuple(FIXED_WINDOWS)}; stream by day and roll up")
    event = without_marks(sdf.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay), time)
    start = F.window(time, FIXED_WINDOWS[window_type])
    counts = event.groupBy(start.alias("_w"), key_or_default(key, default).alias("metric")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counts.select("metric", F.col("_w.start").cast("timestamp_ntz").alias("data_time"), "count")


def stream_key_metric(sdf: DataFrame, key: Column | str, default: str = UNKNOWN) -> DataFrame:
    """Running count per key, without time."""
    return sdf.groupBy(key_or_default(key, default).alias("metric")).agg(F.count(F.lit(1)).alias("count"))


def stream_multi_metric(sdf: DataFrame, specs: Sequence[MetricSpec], time: Column | str | None = None, unit: str = "day",
                        delay: str = "0 seconds") -> DataFrame:
    """Several metrics over one stream: ``metric_type``, ``metric``, ``data_time``, ``count`` and the extra columns as parts.

    Keys, conditions and event times are those of each metric; extra columns have to be ``Mergeable``. All
    are computed by ``unit``, so that only the open units are kept; ``latest_metrics`` rolls what was
    written up to the window of each metric. The watermark follows the newest of all times; ``delay`` has
    to cover how far the times of a record lie apart.
    """
    if unit not in FIXED_WINDOWS:
        raise ValueError(f"unit must be one of {tuple(FIXED_WINDOWS)}")
    mergeable_of(specs)
    if len({s.name for s in specs}) < len(specs):
        raise ValueError("metric names must differ")

    def entry(spec: MetricSpec) -> Column:
        own = spec.time if spec.time is not None else time
        if own is None:
            raise ValueError(f"metric {spec.name!r} has no time")
        when = (F.col(own) if isinstance(own, str) else own).cast("timestamp")
        value = F.struct(F.lit(spec.name).alias("metric_type"), key_or_default(spec.key, spec.default).alias("metric"), when.alias("_time"))
        return value if spec.where is None else F.when(spec.where, value)

    # Only aggregates look at the record itself.
    needed = sdf.columns if any(s.own_aggs() for s in specs) else []
    rows = sdf.select(*needed, F.explode(F.array_compact(F.array(*[entry(s) for s in specs]))).alias("_entry")).select(*needed, "_entry.*")
    found: dict[str, Column] = {}
    for spec in specs:
        for name, agg in spec.own_aggs().items():
            value = F.when(F.col("metric_type") == spec.name, agg.part)
            found[name] = F.coalesce(found[name], value) if name in found else value
    counts = rows.withWatermark("_time", delay).groupBy("metric_type", "metric", F.window("_time", FIXED_WINDOWS[unit]).alias("_w")).agg(
        F.count(F.lit(1)).alias("count"), *[value.alias(name) for name, value in found.items()]
    )
    return counts.select("metric_type", "metric", F.col("_w.start").cast("timestamp_ntz").alias("data_time"), "count", *found)


def latest_metrics(spark: SparkSession, path: str, specs: Sequence[MetricSpec], schema: T.StructType) -> DataFrame:
    """The newest metrics out of the stored updates, by the window of each (none: over all time)."""
    counts = latest_counts(spark, path, METRIC_KEYS, schema)
    start = F.lit(None).cast("timestamp_ntz")
    for spec in specs:
        if spec.window is not None:
            start = F.when(F.col("metric_type") == spec.name, bucket("data_time", spec.window)).otherwise(start)
    return merge_metrics(counts.withColumn("data_time", start), specs, done=True)


def write_updates(stream: DataFrame, path: str, checkpoint: str, idle_s: float | None = None,
                  every: int = COMPACT_EVERY) -> StreamingQuery:
    """Write running counts: a replayed batch replaces what it stored, so it counts once. No
    window is held back at the end. After ``every`` batches the next one takes in the newest
    counts of those before it, whose folders then go; read the counts between runs."""
    keys = [c for c in stream.columns if c in METRIC_KEYS]

    def put(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, path, batch_id, lambda rows: _newest(rows, keys), every)

    writer = stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(idle_s)).start()


def write_closed(stream: DataFrame, path: str, checkpoint: str, idle_s: float | None = None, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Write what is given out once (append mode): closed windows, the state of keys whose time is over.

    ``closed_rows`` reads it, with the batch that gave it out unless later batches have taken it in."""

    def put(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, path, batch_id, lambda rows: rows, every)

    writer = stream.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(idle_s)).start()


def closed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return stored_rows(spark, path, schema)


def latest_counts(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest count per key out of the stored updates."""
    return _newest(stored_rows(spark, path, schema), keys)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    # Parts may hold what cannot be ordered, and a batch has a key once.
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_newest"))
    return newest.select(*keys, "_newest.*")


def store_partials(sdf: DataFrame, partial: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame],
                   path: str, checkpoint: str, idle_s: float | None = None, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Any aggregate that can be merged, over a stream: ``partial`` reduces a micro-batch, ``merge`` puts
    partial rows together. The stream keeps no state, and no row is too late."""

    def put(batch: DataFrame, batch_id: int) -> None:
        store_batch(partial(batch), path, batch_id, merge, every)

    writer = sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(idle_s)).start()


def stored_partials(spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``store_partials`` has stored so far, put together."""
    return merge(stored_rows(spark, path, schema)).select(*schema.names)
