"""Mix sources to target weights by pivotal dependent rounding.

A source of S words whose target is T words needs T / S copies of each document: the
whole part of that, and a fraction that is to be rounded. Two fractions at a time
are paired: words move from one document to the other, either way with the
probability that keeps both expectations, until one of the two is rounded. The
other goes on to the next pair. The words of a source never change by a move, so at
the end a source is off its target by less than one document.

Blocks of documents fold in parallel, and each leaves one unrounded residual. The
residuals of ``BLOCK`` blocks form a block of the next level, up to one per source:
a tree of depth log(documents) / log(BLOCK). A hot source is just more blocks.

Randomness is a hash of the pair, and blocks are cut and ordered by a hash of the
document, so a rerun gives the same mix whatever the partitions are.

Defined results: null text counts as empty (size 0, taken 0); a null source is a
source of its own, the last; rows that agree in identifier, source and size are
interchangeable and share their copies out among themselves; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import named, packed, text_of, unpacked
from tidemark.session import stage

BLOCK = 256
NEAR = 1e-9

_ITEM = "struct<id:{id},size:bigint,rows:bigint,sure:bigint,share:double,order:bigint>"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Per source: its target in words.

    ``sizes`` has a row per source: source, source_size, items. Weights go to the sources
    by code point, null last, and repeat. The words of all sources are shared out by
    weight; nobody gets more than ``cap`` times its size, and what is over goes to the
    others by weight, which is the level at which capped and uncapped shares add up.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(listed) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    # Those that reach their cap first come first; the level holds once a source stays below its cap.
    by_cap = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level).withColumn("below", F.col("level") * F.col("weight") <= F.col("most"))
    place = F.row_number().over(by_cap)
    levels = levels.withColumn("place", place)
    final = F.min(F.when(F.col("below"), F.struct("place", "level"))).over(everything)["level"]
    return levels.withColumn("target", F.least(F.col("most"), F.coalesce(final * F.col("weight"), F.col("most")))).select(
        "source", "source_size", "items", "target"
    )


def _uniform(a: Column, b: Column, seed: int) -> Column:
    """A number in [0, 1) that belongs to the pair."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), a["id"], a["size"], a["order"], b["id"], b["size"], b["order"]), 11) / F.lit(float(1 << 53))


def _fold(items: Column, item_type: str, seed: int) -> Column:
    """Pair the items of a block one after the other: struct (open, done)."""
    done_type = "array<struct<item:" + item_type + ",extra:int>>"
    zero = F.struct(F.lit(None).cast(item_type).alias("open"), F.array().cast(done_type).alias("done"))

    def with_share(item: Column, share: Column) -> Column:
        return item.withField("share", share)

    def settled(item: Column, words: Column) -> Column:
        """Rounded up, rounded down, or null while in between."""
        return F.when(words <= item["size"] * NEAR, 0).when(words >= item["size"] * (1 - NEAR), 1)

    def as_done(item: Column, extra: Column) -> Column:
        return F.array(F.struct(item.alias("item"), extra.cast("int").alias("extra"))).cast(done_type)

    def pair(acc: Column, b: Column) -> Column:
        a = acc["open"]
        a_words, b_words = a["share"] * a["size"], b["share"] * b["size"]
        up, down = F.least(a["size"] - a_words, b_words), F.least(a_words, b["size"] - b_words)
        move = F.when(_uniform(a, b, seed) * (up + down) < down, up).otherwise(-down)
        moved = F.array(F.struct((a_words + move).alias("a"), (b_words - move).alias("b")))

        def after(m: Column) -> Column:
            a_extra, b_extra = settled(a, m["a"]), settled(b, m["b"])
            done = F.concat(
                F.when(a_extra.isNotNull(), as_done(a, a_extra)).otherwise(F.array().cast(done_type)),
                F.when(b_extra.isNotNull(), as_done(b, b_extra)).otherwise(F.array().cast(done_type)),
            )
            still = F.when(a_extra.isNull(), with_share(a, m["a"] / a["size"])).when(b_extra.isNull(), with_share(b, m["b"] / b["size"]))
            return F.struct(still.cast(item_type).alias("open"), F.concat(acc["done"], done).alias("done"))

        return F.get(F.transform(moved, after), 0)

    def step(acc: Column, b: Column) -> Column:
        alone = settled(b, b["share"] * b["size"])
        return (
            F.when(alone.isNotNull(), F.struct(acc["open"].alias("open"), F.concat(acc["done"], as_done(b, alone)).alias("done")))
            .when(acc["open"].isNull(), F.struct(b.alias("open"), acc["done"].alias("done")))
            .otherwise(pair(acc, b))
        )

    return F.aggregate(items, zero, step)


def mix_decisions(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: int = 7,
) -> DataFrame:
    """One row per distinct (id, source, size).

    rows (that agree in the three), whole (copies that each of them gets), sure (rows
    that get one more), extra (1 if one further row does), source_size, target.
    """
    docs = df.select(named(id_col).alias("id"), named(source_col).cast("string").alias("source"), word_count(text_of(text_col)).alias("size"))
    items = stage(docs.groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "mix-items")
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("items"))
    sources = stage(targets(sizes, weights, cap), "mix-sources")
    item_type = _ITEM.format(id=items.schema["id"].dataType.simpleString())

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(F.col("ratio") + NEAR), F.lit(int(cap)))
    fraction = F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)) * F.col("rows")
    sure = F.floor(F.col("fraction") + NEAR)
    order = F.xxhash64("id", "size", F.lit(seed))
    known = (
        items.join(sources, items["source"].eqNullSafe(sources["source"])).drop(sources["source"])
        .withColumn("ratio", ratio).withColumn("whole", whole).withColumn("fraction", fraction).withColumn("sure", sure)
        .withColumn("share", F.greatest(F.col("fraction") - F.col("sure"), F.lit(0.0)))
        .withColumn("order", order)
        .withColumn("block", F.pmod("order", F.ceil(F.col("items") / BLOCK)))
    )
    item = F.struct("id", "size", "rows", "sure", "share", "order").cast(item_type)
    per_source = ["source", "source_size", "target", "whole"]
    level = known.select(*per_source, "block", item.alias("item"))
    most = sources.agg(F.max("items")).first()[0] or 0
    parts = []
    while True:
        by_order = F.array_sort(F.collect_list("item"), lambda x, y: F.when(x["order"] < y["order"], -1).when(x["order"] > y["order"], 1).when(x["id"] < y["id"], -1).when(x["id"] > y["id"], 1).when(x["size"] < y["size"], -1).when(x["size"] > y["size"], 1).otherwise(0))
        folded = stage(
            level.groupBy(*per_source, "block").agg(by_order.alias("items"))
            .select(*per_source, "block", _fold(F.col("items"), item_type, seed).alias("fold")),
            "mix-level",
        )
        parts.append(folded.select(*per_source, F.inline("fold.done")))
        left = folded.where("fold.open is not null").select(*per_source, "block", F.col("fold.open").alias("item"))
        most = -(-most // BLOCK)
        if most <= 1:
            break
        level = left.withColumn("block", F.floor(F.col("block") / BLOCK))
    # The last residual of a source has nobody to pair with: its share decides.
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "item.id", "item.size", "source"), 11) / F.lit(float(1 << 53))
    parts.append(left.select(*per_source, "item", (u < F.col("item.share")).cast("int").alias("extra")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("item.id", "source", "item.size", "item.rows", "whole", "item.sure", "extra", "source_size", "target")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per input row: id, size, source_size, target, copies, taken (words: copies times size)."""
    decided = mix_decisions(df, id_col, text_col, source_col, **options)
    rows = decided.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = _copies(F.col("row"))
    return rows.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def _copies(row: Column) -> Column:
    more = F.when(row <= F.col("sure"), 1).when(row == F.col("sure") + 1, F.col("extra")).otherwise(0)
    return (F.col("whole") + more).cast("long")


def apply_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix with all their columns: each as often as it has copies."""
    decided = mix_decisions(df, id_col, text_col, source_col, **options).select("id", "source", "size", "whole", "sure", "extra")
    docs = df.select(
        named(id_col).alias("d_id"), named(source_col).cast("string").alias("d_source"), word_count(text_of(text_col)).alias("d_size"),
        F.xxhash64(text_of(text_col)).alias("text_hash"), packed(df).alias("doc"),
    )
    same = docs["d_id"].eqNullSafe(decided["id"]) & docs["d_source"].eqNullSafe(decided["source"]) & (docs["d_size"] == decided["size"])
    ranked = docs.join(decided, same).withColumn(
        "row", F.row_number().over(Window.partitionBy("d_id", "d_source", "d_size").orderBy("text_hash"))
    )
    out = ranked.withColumn("copies", _copies(F.col("row"))).where("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*unpacked("doc", df.columns))
