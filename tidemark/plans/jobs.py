"""Whole jobs: a prepared input, its outputs and its metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import ntz
from tidemark.operators.changes import apply_changes, flatten_changes
from tidemark.operators.metrics import LABELS, MetricSpec, merge_metrics, merge_partials, mergeable_of, multi_metric, user_behaviour_metric
from tidemark.operators.transforms import add_fields, clean_behaviour, strip_temp
from tidemark.session import stage, staged
from tidemark.sinks.batches import store_batch, stored_rows
from tidemark.sinks.tables import Sink, fan_out
from tidemark.sources.records import change_feed
from tidemark.streaming.metrics import COMPACT_EVERY
from tidemark.streaming.runs import trigger_options


@dataclass(frozen=True)
class Job:
    """Records to several outputs and, from the same pass, to metrics.

    ``transforms`` run in order. Fields made by ``with_temp`` reach the metrics
    and not the outputs.
    """

    transforms: Sequence[Callable[[DataFrame], DataFrame]] = ()
    outputs: Sequence[Sink] = ()
    metrics: Sequence[MetricSpec] = ()
    metric_sink: Callable[[DataFrame], None] | None = None
    time: str | Column | None = None
    labels: Sequence[str] = LABELS

    def prepare(self, df: DataFrame) -> DataFrame:
        for step in self.transforms:
            df = step(df)
        return df

    def run(self, df: DataFrame) -> None:
        """The records are computed once, into the shared folder. Outputs and
        metrics read from there, each only the columns it needs; then the copy goes."""
        with staged(self.prepare(df), "job") as rows:
            fan_out(strip_temp(rows), self.outputs, computed=False)
            if self.metrics and self.metric_sink is not None:
                self.metric_sink(multi_metric(rows, self.metrics, self.time, self.labels))

    def stream(self, sdf: DataFrame, outputs: Callable[[int], Sequence[Sink]], metric_path: str, checkpoint: str,
               idle_s: float | None = None, every: int = COMPACT_EVERY) -> StreamingQuery:
        """The job over a stream. ``outputs`` gets the id of the micro-batch, for folders that a replay
        replaces; the metrics of each batch are stored as parts under ``metric_path`` and put together by
        ``stored_metrics``. Extra columns have to be ``Mergeable``."""
        mergeable_of(self.metrics)

        def put(batch: DataFrame, batch_id: int) -> None:
            with staged(self.prepare(batch), "job") as rows:
                fan_out(strip_temp(rows), outputs(batch_id), computed=False)
                if self.metrics:
                    store_batch(multi_metric(rows, self.metrics, self.time, parts=True), metric_path, batch_id, lambda p: merge_metrics(p, self.metrics), every)

        writer = sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger_options(idle_s)).start()


    def stored_metrics(self, df: DataFrame, metric_path: str) -> DataFrame:
        """What ``stream`` has stored so far; ``df`` is any frame with the fields of the stream."""
        schema = multi_metric(self.prepare(df), self.metrics, self.time, parts=True).schema
        return merge_metrics(stored_rows(df.sparkSession, metric_path, schema), self.metrics, done=True)


def add_up(partials: DataFrame) -> DataFrame:
    """Counts of several metrics out of partial ones."""
    return merge_partials(partials, ["metric_type", "metric", "data_time"])


def detail_and_metrics(df: DataFrame, specs: Sequence[MetricSpec], time: str | Column | None = None,
                       labels: Sequence[str] = LABELS) -> tuple[DataFrame, DataFrame]:
    """Detail records (without temp fields) and metrics over one staged copy."""
    rows = stage(df, "detail")
    return strip_temp(rows), multi_metric(rows, specs, time, labels)


def table_to_metrics(df: DataFrame, specs: Sequence[MetricSpec], time: str | Column,
                     labels: Sequence[str] = LABELS) -> DataFrame:
    """Operation log to metric rows: one scan, one shuffle."""
    return multi_metric(df, specs, time, labels)


def lines_to_behaviour(lines: DataFrame, line_col: str, now: datetime, order_cols: Sequence[str],
                       search_word: Column, scene: Column) -> DataFrame:
    """Raw behaviour lines to one row per user and day."""
    rows = clean_behaviour(lines, line_col).filter(F.col("reject_reason").isNull())
    rows = add_fields(rows, COLLECT_TIME=ntz(now), CREATE_TIME=ntz(now), UPDATE_TIME=ntz(now))
    rows = rows.withColumns({"searchWords_var": search_word, "XY_SCENE": scene})
    return user_behaviour_metric(rows, order_cols)


def feed_to_table(feed: DataFrame, table: str, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes of one source table, applied to its target."""
    return apply_changes(target, flatten_changes(change_feed(feed, [table]), keys), keys)
