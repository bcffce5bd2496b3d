"""Running streams and repeated incremental jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.changes import flatten_changes
from tidemark.operators.lookups import On, lookup_as_of
from tidemark.operators.metrics import counted
from tidemark.operators.transforms import Rules, reject_reason
from tidemark.session import staged
from tidemark.sinks.batches import store_batch, stored_rows
from tidemark.sinks.tables import Sink, append_changes, fan_out
from tidemark.sources.state import StateTable
from tidemark.sources.tables import Increment


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None,
                archive_dir: str | None = None, max_age: str | None = None, **options: str) -> DataFrame:
    """New files as they come, each once. Finished files can go to an archive
    folder, files older than ``max_age`` (as ``7d``) are left out."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_age:
        reader = reader.option("maxFileAge", max_age)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def trigger_options(idle_s: float | None = None) -> dict[str, Any]:
    """Micro-batch control: every ``idle_s`` seconds, or once through what is there."""
    if idle_s is None:
        return {"availableNow": True}
    return {"processingTime": f"{idle_s} seconds"}


def drain(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for what is there to be processed. A query that runs on is stopped then."""
    if query.isActive and timeout_s is None:
        query.processAllAvailable()
        query.stop()
    else:
        query.awaitTermination(timeout_s)


def _dropped(progress: Any) -> int:
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in progress["stateOperators"])


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark and were dropped.

    A query keeps its newest batches only; beyond them this is an error, and a
    ``LateRows`` listener, added before the query starts, has the whole number.
    """
    kept = query.recentProgress
    limit = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(kept) >= limit and kept[0]["batchId"] > 0:
        raise ValueError("older batches are no longer known; add a LateRows listener before the query starts")
    return sum(_dropped(p) for p in kept)


class LateRows(StreamingQueryListener):
    """Counts dropped rows of all batches: ``spark.streams.addListener(counter := LateRows())``."""

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        key = str(event.progress.id)
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.by_query[key] = self.by_query.get(key, 0) + dropped

    def onQueryTerminated(self, event: Any) -> None:
        pass


def run_increment(scan: Callable[[Any], Increment], write: Callable[[DataFrame], None], state: StateTable, job_id: str,
                  default: Any = None, from_first: bool = False) -> Any:
    """One run of a repeated incremental job: read the mark, scan, write, then store
    the new mark. A crash before the last step repeats the run, so ``write`` must
    be safe to repeat (an upsert, or a folder per run)."""
    last = state.read(job_id, default, from_first)
    found = scan(last)
    write(found.rows)
    mark = found.mark()
    if mark is not None and (from_first or mark != last):
        state.commit(job_id, mark)
    return mark


def stream_apply(sdf: DataFrame, path: str, keys: Sequence[str], checkpoint: str, seq: str = "seq",
                 idle_s: float | None = None) -> StreamingQuery:
    """Store a change feed batch by batch as latest changes per key. The target is
    the base table with ``apply_changes`` of all stored batches."""

    def put(batch: DataFrame, batch_id: int) -> None:
        append_changes(flatten_changes(batch, keys), path, batch_id, keys, seq)

    writer = sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(idle_s)).start()


def stream_fan_out(sdf: DataFrame, sinks: Callable[[int], Sequence[Sink]], checkpoint: str,
                   idle_s: float | None = None) -> StreamingQuery:
    """Several outputs per micro-batch. ``sinks`` gets the batch id, for folders that a replay replaces."""

    def put(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, sinks(batch_id))

    writer = sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(idle_s)).start()


def stream_lookup_as_of(sdf: DataFrame, versions: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str,
                        on: On, time: str, valid_from: str, alias: str, fields: Sequence[str], idle_s: float | None = None) -> StreamingQuery:
    """Records of a stream with the dimension row valid at their own time (``lookup_as_of``).

    ``versions`` is asked for in each micro-batch, so a change that came in between counts for the records
    after it and leaves those before it alone. ``write`` gets the batch and its id and has to be safe to
    repeat. A version that comes after the records of its time were written changes none of them.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        write(lookup_as_of(batch, versions(), on, time, valid_from, alias, fields), batch_id)

    return sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger_options(idle_s)).start()


COUNTS = "total bigint, success bigint, failed bigint, ignored bigint"


def stream_checked(sdf: DataFrame, rules: Rules, accept: Callable[[DataFrame, int], None], reject: Callable[[DataFrame, int], None],
                   counts_path: str, checkpoint: str, ignored: Column | None = None, idle_s: float | None = None, every: int = 64) -> StreamingQuery:
    """Good records to ``accept``, the others with their reason to ``reject``, and how many of each, batch by batch.

    ``rules`` are (reason, condition); records that are ``ignored`` and break no rule go nowhere. The numbers
    are observed while the batch is written once for both outputs, and stored with the id of the batch, so a
    replay counts once and a restart goes on: ``stream_counts`` adds them up.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("reject_reason", reject_reason(rules))
        bad = F.col("reject_reason").isNotNull()
        skipped = F.lit(False) if ignored is None else F.coalesce(ignored, F.lit(False))
        seen, numbers = counted(marked.withColumn("_skipped", skipped), bad, F.col("_skipped"))
        with staged(seen, "checked") as rows:
            accept(rows.where(~bad & ~F.col("_skipped")).drop("reject_reason", "_skipped"), batch_id)
            reject(rows.where(bad).drop("_skipped"), batch_id)
        found = numbers.get
        row = [tuple(int(found[c]) for c in ("total", "success", "failed", "ignored"))]
        store_batch(batch.sparkSession.createDataFrame(row, COUNTS), counts_path, batch_id, _added, every)

    return sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**trigger_options(idle_s)).start()


def _added(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.sum(c).alias(c) for c in ("total", "success", "failed", "ignored")])


def stream_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: total, success, failed, ignored of all batches so far."""
    return _added(stored_rows(spark, path, T.StructType.fromDDL(COUNTS)))
