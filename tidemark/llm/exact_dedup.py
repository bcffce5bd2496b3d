"""Exact dedup by sorting whole texts.

Spark samples splitters of the sort key and deals the rows out by range; each task
sorts its range externally, which places equal texts next to each other, and every
row is compared in full with the row before it. The range key is bounded (the first
characters, a hash, a part number), so the splitters stay small for any text; the
text itself is the last sort key inside the task.

A text that many rows share is dealt out over several parts by a hash of the
identifier. Only the best row of each part meets the others again, once more with
a full comparison.

Defined results: null text counts as empty; a null identifier loses against any
other; of rows that share both text and identifier exactly one is kept; an empty
table gives an empty result; further columns are carried untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import named, packed, text_of, unpacked

# A text with more rows than a part may hold is split. A part holds one in HOT_KEYS
# of all rows, but at least PART_ROWS, so at most HOT_KEYS texts are ever split:
# their list (two numbers each) is the only thing that is broadcast.
HOT_KEYS = 10_000
PART_ROWS = 256
PREFIX = 32

SORT_KEY = ("prefix", "hash", "part")


def _unchanged(text: Column) -> Column:
    return text


def _dealt(df: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column], carry: list[Column]) -> DataFrame:
    """Rows with their sort key; ``parts`` is null unless the text is split."""
    keyed = df.select(named(id_col).alias("id"), normalise(text_of(text_col)).alias("body"), *carry).withColumns(
        {"prefix": F.substring("body", 1, PREFIX), "hash": F.xxhash64("body")}
    )
    unit = max(PART_ROWS, -(-df.count() // HOT_KEYS))
    split = (
        keyed.groupBy("hash").agg(F.count("*").alias("rows")).where(F.col("rows") > unit)
        .select("hash", F.ceil(F.col("rows") / unit).alias("parts"))
    )
    part = F.coalesce(F.pmod(F.xxhash64("id"), "parts"), F.lit(0).cast("long"))
    return keyed.join(F.broadcast(split), "hash", "left").withColumn("part", part)


def _runs(dealt: DataFrame, largest: bool) -> DataFrame:
    """Sort, compare neighbours: ``first`` marks the best row of a run, ``best`` carries its identifier along."""
    best_first = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    ranged = dealt.repartitionByRange(*SORT_KEY)
    order = Window.partitionBy(*SORT_KEY, "parts").orderBy("body", best_first)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = ~F.lag("body").over(order).eqNullSafe(F.col("body"))
    return (
        ranged.withColumn("first", first)
        .withColumn("best", F.last(F.when(F.col("first"), F.struct("id")), ignorenulls=True).over(so_far)["id"])
        .withColumn("run", F.sum(F.col("first").cast("long")).over(so_far))
    )


def _sized(runs: DataFrame) -> DataFrame:
    """Rows of each run, counted without its text."""
    run = Window.partitionBy(*SORT_KEY, "parts", "run")
    return runs.withColumn("sha", F.sha2("body", 256)).drop("body").withColumn("size", F.count("*").over(run))


def _joined_parts(hot: DataFrame, largest: bool) -> DataFrame:
    """The best rows of all parts of a split text, compared in full again: the best of all, and all rows."""
    run = Window.partitionBy(*SORT_KEY, "parts", "run")
    firsts = hot.withColumn("size", F.count("*").over(run)).where("first").select(*SORT_KEY, "run", "body", "best", "size")
    text = Window.partitionBy("prefix", "hash", "body")
    best_first = F.col("best").desc_nulls_last() if largest else F.col("best").asc_nulls_last()
    return firsts.select(
        *SORT_KEY, "run",
        F.first("best").over(text.orderBy(best_first).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_best"),
        F.sum("size").over(text).alias("all_size"),
    )


def _marked(df: DataFrame, id_col: str, text_col: str, keep: str, normalise, carry: list[Column]) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    largest = keep == "largest"
    dealt = _dealt(df, id_col, text_col, normalise, carry)
    whole = _sized(_runs(dealt.where("parts is null"), largest))
    hot = _runs(dealt.where("parts is not null"), largest)
    joined = _joined_parts(hot, largest)
    kept = F.col("first") & F.col("id").eqNullSafe(F.col("all_best"))
    split = _sized(hot).join(joined, [*SORT_KEY, "run"]).withColumns({"first": kept, "best": F.col("all_best"), "size": F.col("all_size")})
    return whole.unionByName(split.select(*whole.columns))


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalise: Callable[[Column], Column] = _unchanged,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    marked = _marked(df, id_col, text_col, keep, normalise, [])
    return marked.select(
        F.col("id").alias(id_col), F.col("best").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("first").alias("kept"), F.col("sha").alias("text_sha256"),
    )


def drop_copies(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    normalise: Callable[[Column], Column] = _unchanged,
) -> DataFrame:
    """The rows that stay, with all their columns. The text is shuffled once."""
    marked = _marked(df, id_col, text_col, keep, normalise, [packed(df).alias("row")])
    return marked.where("first").select(*unpacked("row", df.columns))
