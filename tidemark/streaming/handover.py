"""History handed over to a live feed, in one stream: no gap and nothing twice."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.streaming.flush import EndMarks, without_marks

FAR = datetime(9000, 1, 1)


def history_then_live(history: DataFrame, live: DataFrame, keys: Sequence[str], time: str, seam: datetime, overlap: str, marks: EndMarks) -> DataFrame:
    """Both streams as one. ``seam`` is a time from which the live feed has everything; it must stay the same over restarts.

    History before the seam goes through as it is, in any order and without state. From the seam on both
    may have a record: it is known by ``keys`` and taken once (``dropDuplicatesWithinWatermark``). Either
    side may be ahead of the other, as the watermark follows the one that is behind; within a side records
    come at most ``overlap`` late. When the history is at its end, ``end_history`` lets the watermark
    follow the live feed, and the state of the seam is forgotten. ``time`` must not be null in the live feed.
    """
    stamped = history.withColumn(time, F.col(time).cast("timestamp"))
    start = F.lit(seam).cast("timestamp")
    old = stamped.filter(F.coalesce(F.col(time) < start, F.lit(True)))
    seamed = marks.attach(stamped.filter(F.col(time) >= start), time)
    near = without_marks(seamed.withWatermark(time, overlap), time)
    fresh = live.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, overlap)
    once = near.unionByName(fresh, allowMissingColumns=True).dropDuplicatesWithinWatermark(list(keys))
    return old.unionByName(once, allowMissingColumns=True)


def end_history(marks: EndMarks) -> None:
    """All of the history was read: what was put behind this is not expected to come."""
    marks.put(FAR, 1)


