"""What micro-batches store: a folder each, and a commit log that says which folders count."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import drop_folder
from tidemark.sinks.commits import CommitLog

BATCH = T.StructField("batch_id", T.LongType())


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}/_commits")


def _read(spark: SparkSession, schema: T.StructType, folders: Iterable[str]) -> DataFrame:
    full, found = T.StructType([*schema.fields, BATCH]), list(folders)
    return spark.read.schema(full).parquet(*found) if found else spark.createDataFrame([], full)


def store_batch(batch: DataFrame, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame], every: int) -> None:
    """Store what a micro-batch gives; a replay of the batch replaces it.

    After ``every`` batches the next one takes in (``merge``, over rows with ``batch_id``) what they
    have stored. Readers follow the newest commit, so rows that were taken in count once, whichever
    batch is the last. Folders that no commit needs go with the next batch: until then a replay may
    ask for them.
    """
    spark, root = batch.sparkSession, path.rstrip("/")
    log = _log(spark, root)
    version, state = log.latest()
    last = state.get("last", -1)
    if batch_id < last:
        raise ValueError(f"{root} holds batch {last}, so batch {batch_id} is of another run: use its own folder or the first run's checkpoint")
    replayed = batch_id == last
    earlier: dict[str, str] = state.get("before" if replayed else "batches", {})
    needless = set(state.get("batches", {}).values()) - set(earlier.values()) if replayed else set(state.get("before", {}).values()) - set(earlier.values())

    rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    kept = earlier
    if len(earlier) >= every:
        taken = merge(_read(spark, batch.schema, earlier.values()).unionByName(rows))
        rows, kept = taken.select(*batch.columns, F.lit(batch_id).cast("bigint").alias("batch_id")), {}
    folder = f"{root}/batch-{batch_id}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    log.commit(version + 1, {"last": batch_id, "batches": kept | {str(batch_id): folder}, "before": earlier})
    for old in needless:
        drop_folder(spark, old)


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that count, with the ``batch_id`` that stored them. Read them between runs."""
    return _read(spark, schema, _log(spark, path).latest()[1].get("batches", {}).values())
