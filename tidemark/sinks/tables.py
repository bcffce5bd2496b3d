"""Writers: tables, routed and rolling output, fan-out."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from itertools import islice
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.functions import ntz, zero_pad
from tidemark.operators.changes import DELETE, compact_changes
from tidemark.operators.metrics import metrics_by_target
from tidemark.operators.numbering import first_n, number_rows
from tidemark.session import staged
from tidemark.sinks.records import labelled

DATE_PART = re.compile(r"\{dateformat=([^}]+)\}")


def table_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def jdbc_append(df: DataFrame, url: str, table: str, batch_size: int = 1000, parts: int | None = None,
                **options: str) -> None:
    """Batched insert over JDBC; ``parts`` caps the number of connections."""
    rows = df.coalesce(parts) if parts else df
    rows.write.mode("append").format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_size), **options
    ).save()


def overwrite(df: DataFrame, path: str) -> None:
    """Clear the target, then load it."""
    df.write.mode("overwrite").parquet(path)


def noop_sink(df: DataFrame, show: int = 0) -> None:
    """Run everything, write nothing; optionally print some records."""
    if show:
        df.show(show, truncate=False)
    df.write.format("noop").mode("overwrite").save()


def target_name(pattern: str, time: Column | datetime | str) -> Column:
    """Target name of a record: ``{dateformat=…}`` in the pattern becomes the time in that format."""
    when = time if isinstance(time, Column) else ntz(time)
    pieces = DATE_PART.split(pattern)
    cols = [F.lit(p) if i % 2 == 0 else F.date_format(when, p) for i, p in enumerate(pieces)]
    return F.concat(*cols)


def route_by_file(df: DataFrame, path_col: str, routes: Mapping[str, str], default: str,
                  name: str = "_target") -> DataFrame:
    """Target by the end of the source file's name."""
    found = F.lit(default)
    for suffix, target in reversed(list(routes.items())):
        found = F.when(F.col(path_col).endswith(suffix), F.lit(target)).otherwise(found)
    return df.withColumn(name, found)


def write_routed(df: DataFrame, path: str, target_col: str = "_target", mode: str = "append") -> None:
    """One folder per target. Rows are balanced by size: a target that takes most
    rows is written by many tasks, small ones do not become many files."""
    df.hint("rebalance", target_col).write.mode(mode).partitionBy(target_col).parquet(path)


def rolling_write(df: DataFrame, path: str, max_records: int, run: str, order_cols: Sequence[str] | None = None,
                  fmt: str = "json") -> None:
    """Files of at most ``max_records`` records, under ``run=<run>``.

    With ``order_cols`` the files are consecutive pieces of that order, each in
    ``file_seq=<six digits>``; without, Spark just rolls its files over.
    """
    target = f"{path.rstrip('/')}/run={run}"
    if order_cols is None:
        df.write.mode("overwrite").option("maxRecordsPerFile", max_records).format(fmt).save(target)
        return
    numbered = with_file_seq(df, order_cols, max_records)
    numbered.repartition("file_seq").write.mode("overwrite").partitionBy("file_seq").format(fmt).save(target)


def with_file_seq(df: DataFrame, order_cols: Sequence[str], max_records: int, first: int = 1) -> DataFrame:
    """Six-digit number of the file that a record goes to."""
    numbered = number_rows(df, order_cols, "_no")
    seq = F.floor(F.col("_no") / max_records).cast("bigint") + first
    return numbered.withColumn("file_seq", zero_pad(seq)).drop("_no")


def labelled_export(df: DataFrame, path: str, titles: Sequence[tuple[str, str]]) -> None:
    labelled(df, titles).write.mode("overwrite").csv(path, header=True)


def custom_sink(df: DataFrame, fn: Callable[[list[dict[str, Any]], dict[str, Any]], None], batch_size: int = 1000,
                context: Mapping[str, Any] | None = None) -> None:
    """Hand lists of records and a context to ``fn``, inside the tasks."""
    shared = dict(context or {})

    def run(rows: Iterable[Row]) -> None:
        rest = iter(rows)
        while batch := [r.asDict(recursive=True) for r in islice(rest, batch_size)]:
            fn(batch, shared)

    df.foreachPartition(run)


@dataclass(frozen=True)
class Sink:
    """One output of a fan-out: its own filter, first-n cut and fields, then ``write``."""

    name: str
    write: Callable[[DataFrame], None]
    filter: Column | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    limit: int | None = None
    order: Sequence[str] = ()
    batch: str | None = None

    def frame(self, df: DataFrame) -> DataFrame:
        rows = df if self.filter is None else df.filter(self.filter)
        if self.limit is not None:
            if not self.order:
                raise ValueError(f"sink {self.name!r}: a limit needs an order")
            rows = first_n(rows, self.limit, self.order, self.batch)
        return rows if self.transform is None else self.transform(rows)


def fan_out(df: DataFrame, sinks: Sequence[Sink], computed: bool = True) -> None:
    """One read, many outputs. The records are computed once into the shared
    folder; each output then scans only its columns and rows, and the copy goes
    when the last one is written. Records that are a plain table already
    (``computed=False``) are not copied."""
    with staged(df, "fan-out") if computed and len(sinks) > 1 else nullcontext(df) as rows:
        for sink in sinks:
            sink.write(sink.frame(rows))


def write_metrics(metrics: DataFrame, path: str, targets: Mapping[str, str], fields: Mapping[str, Mapping[str, str]] | None = None,
                  mode: str = "overwrite") -> None:
    """One table per metric type; ``fields`` renames columns per type."""
    with staged(metrics, "metrics") as rows:
        for name, frame in metrics_by_target(rows, list(targets)).items():
            frame = frame.drop("metric_type").withColumnsRenamed(dict((fields or {}).get(name, {})))
            frame.write.mode(mode).parquet(f"{path.rstrip('/')}/{targets[name]}")


def merge_into(changes: DataFrame, table: str, keys: Sequence[str], seq: str = "seq", op: str = "op") -> None:
    """Apply changes to a table whose format can merge: it rewrites only what the
    changed keys touch. Plain Parquet cannot; use ``apply_changes`` or ``append_changes``."""
    cols = changes.sparkSession.table(table).columns
    last = compact_changes(changes, keys, seq).select(F.col(op).alias("_op"), *cols).alias("change")
    same = reduce(and_, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"change.{k}")) for k in keys])
    values = {c: F.col(f"change.{c}") for c in cols}
    gone = F.col("change._op") == DELETE
    merge = last.mergeInto(table, same).whenMatched(gone).delete().whenMatched().update(values)
    merge.whenNotMatched(~gone).insert(values).merge()


def append_changes(changes: DataFrame, path: str, batch_id: int, keys: Sequence[str], seq: str = "seq") -> None:
    """Store the latest change per key of one batch. Writing the same batch again replaces it."""
    out = f"{path.rstrip('/')}/batch_id={batch_id}"
    compact_changes(changes, keys, seq).write.mode("overwrite").parquet(out)


def read_changes(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The stored changes of all batches, with ``batch_id``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path)
