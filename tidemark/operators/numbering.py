"""Row numbers over a whole table without one task that sorts it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import stage

# monotonically_increasing_id() has the number of the partition above these bits.
PLACE_BITS = 33
# Bytes of a range, which one task sorts, and ranges per shuffle partition at most.
RANGE_BYTES = 1 << 28
MOST_RANGES = 64


def number_rows(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "row_no",
    start: int = 0,
    rows_per_range: int | None = None,
    only: tuple[int, int] | None = None,
) -> DataFrame:
    """Add consecutive numbers in the order of ``order_cols`` (ascending).

    Spark deals the rows out by range of their keys and each task sorts its range, so
    the place of a row is the number of its range and its place there. The rows are
    written once with that place, to the shared folder: a lost task finds the same
    numbers again. The sizes of the ranges, one small row each, add up to where each
    range starts, and go to all tasks (there are at most ``MOST_RANGES`` per shuffle
    partition). There is a range per ``RANGE_BYTES`` of the estimated input, at least one
    per shuffle partition, or one per ``rows_per_range`` rows; any table takes the same path.

    ``order_cols`` must identify a row; otherwise equal rows are in no set order.
    ``only`` = (first, last) keeps the rows with these numbers and reads no range
    without one of them.
    """
    ranges = _ranges(df) if rows_per_range is None else max(1, math.ceil(df.count() / rows_per_range))
    dealt = df.repartitionByRange(ranges, *order_cols).sortWithinPartitions(*order_cols)
    # A file holds one range, so what is asked of a range is known from its footer.
    placed = stage(dealt.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    place, in_range = F.col("_place"), F.shiftright("_place", PLACE_BITS)
    sizes = placed.groupBy(in_range.alias("_range")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)) + F.lit(start))
    if only is not None:
        asked = starts.filter((F.col("_start") <= only[1]) & (F.col("_start") + F.col("_size") > only[0]))
        first, last = asked.agg(F.min("_range"), F.max("_range")).first()
        if first is None:
            return placed.limit(0).select(*df.columns, F.lit(0).cast("bigint").alias(name))
        placed = placed.filter(place.between(first << PLACE_BITS, ((last + 1) << PLACE_BITS) - 1))
    number = F.col("_start") + place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    numbered = placed.withColumn("_range", in_range).join(F.broadcast(starts), "_range")
    out = numbered.select(*df.columns, number.cast("bigint").alias(name))
    return out if only is None else out.filter(F.col(name).between(*only))


def _ranges(df: DataFrame) -> int:
    """By size, as Spark estimates it; an estimate can be far too large, so it counts up to a bound only."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(parts, min(size // RANGE_BYTES, parts * MOST_RANGES))


def first_n(df: DataFrame, n: int, order_cols: Sequence[str], batch_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each batch, or of the whole input.

    Spark cuts each map task's part down to ``n`` rows per batch before the
    shuffle, so a batch that holds most rows moves no more data than others.
    """
    if batch_col is None:
        return df.orderBy(*order_cols).limit(n)
    ranked = F.row_number().over(Window.partitionBy(batch_col).orderBy(*order_cols))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") <= n).drop("_rank")
