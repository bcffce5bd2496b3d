"""SimHash near-dedup.

Fingerprints: one pass over the texts, in Arrow batches. From then on only numbers move.

Links: a fingerprint is embedded as the bit counts of its 32 segments of 2 bits.
The Manhattan distance of two such points is at most the number of differing bits,
so it is a lower bound. Points within a distance of 2 have a grid point in common
that is at most 1 away from both: every fingerprint is dealt to its own grid point
and the at most 64 beside it, and only those that meet another one there go on (the range
join). They are then verified exactly in the same manner, bit by bit: two
fingerprints differ in at most 2 bits if and only if they share a fingerprint that is
at most one bit away from both. All that share one are linked to the smallest of
them, so a group of any size gives links in proportion to its rows, never all pairs,
and no link between different fingerprints is lost.

Components: alternating large-star and small-star rounds, each written to the shared
folder, until nothing changes. Equal fingerprints are one node throughout.

Defined results: null text counts as empty; a text without words has fingerprint
zero and is linked like any other; a null identifier counts as the largest; repeated
rows share a component, and exactly one of them is marked as kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import named, packed, ready, text_of, unpacked
from tidemark.session import drop_folder, shared_folder, stage

SEED = 42
# Short segments keep chance meetings rare: two random fingerprints are within a distance of 2 once in 10^10.
LOW_BITS = 0x5555555555555555
DISTANCE = 2
CHUNK = 1 << 14


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64 bits of a text in UTF-8: a bit is set if it is in over half the shingle hashes."""
    import xxhash

    words = text.lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(first[at:min(at + CHUNK, n)].tolist(), ends[at:at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, text_hash, fp (the 64 bits as a signed number)."""
    ready(df.sparkSession)
    source = df.select(named(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), text_of(text_col).cast("binary").alias("body"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column("body")]
            fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), fps], names=["id", "text_hash", "fp"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(batches, f"id {kind}, text_hash bigint, fp bigint")


def _point(fp: Column) -> Column:
    """The grid point of a fingerprint: two bits for the count of each segment."""
    low, high = fp.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))


def _signed(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def _meeting(fps: DataFrame) -> DataFrame:
    """Fingerprints that share a grid point with another one: the lower bound lets them through."""
    # A step changes one count: 01 between 0 and 1, 11 between 1 and 2; 0 stays.
    steps = F.array(*[_signed(bits << at) for bits in (1, 3) for at in range(0, 64, 2)], F.lit(0).cast("long"))
    step, point = F.col("step"), F.col("point")
    possible = F.when(step.bitwiseAND(F.lit(LOW_BITS)) == step, point.bitwiseAND(F.shiftleft(step, 1)) == 0).otherwise(point.bitwiseAND(step) != 0)
    around = fps.select("fp", _point(F.col("fp")).alias("point"), F.explode(steps).alias("step")).where(possible)
    around = around.select("fp", point.bitwiseXOR(step).alias("point"))
    here = Window.partitionBy("point")
    return around.select("fp", F.min("fp").over(here).alias("lo"), F.max("fp").over(here).alias("hi")).where("lo < hi").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a > b) whose components are those of all pairs with at most 2 differing bits.

    ``fps`` has distinct fingerprints. At most 65 of them share a middle, and the number
    of links is at most 65 per fingerprint.
    """
    flips = F.array(F.lit(0).cast("long"), *[_signed(1 << bit) for bit in range(64)])
    near = _meeting(fps).select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    least = F.min("fp").over(Window.partitionBy("middle"))
    return near.select(F.col("fp").alias("a"), least.alias("b")).where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of the component for every node of ``edges`` (a, b): node, root."""
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_folder(spark, "links")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first())

    now, path = written(edges)
    before = state(now)
    while before[0]:
        # Large star: everything above a node is linked to the least of its neighbourhood.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large, large_path = written(large)
        # Small star: a node and what is below it are linked to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        small, small_path = written(small)
        after = state(small)
        drop_folder(spark, path)
        drop_folder(spark, large_path)
        now, path = small, small_path
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (its smallest identifier), text_hash, kept.

    One row of a component is kept: that of the smallest identifier, then text hash, then any of those that repeat it.
    """
    if distance != DISTANCE:
        raise ValueError("the shared middle of two fingerprints proves 2 differing bits, no other number")
    docs = stage(fingerprints(df, id_col, text_col, shingle).withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"), F.col("place").alias("place"))
    nodes = stage(docs.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("rows")), "nodes")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    member = rooted.select("fp", "root").join(firsts, "root").select("fp", "first")
    kept = F.col("place") == F.col("first.place")
    return docs.join(member, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"), "text_hash", kept.alias("kept"),
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with all its columns. Of rows that agree in identifier and text any one stays."""
    found = simhash_dedup(df, id_col, text_col, shingle, distance)
    # Documents of which not every row stays: mostly all rows go, and one stays where the kept row is repeated.
    decided = found.groupBy(named(id_col).alias("id"), "text_hash").agg(F.max("kept").alias("one"), F.count("*").alias("rows"))
    decided = decided.where(~F.col("one") | (F.col("rows") > 1))
    docs = df.select(named(id_col).alias("d_id"), F.xxhash64(text_of(text_col)).alias("d_hash"), packed(df).alias("doc"))
    same = docs["d_id"].eqNullSafe(decided["id"]) & (docs["d_hash"] == decided["text_hash"])
    met = docs.join(decided, same, "left")
    nth = F.row_number().over(Window.partitionBy("d_id", "d_hash").orderBy(F.lit(1)))
    repeated = met.where("one").select("d_id", "d_hash", "doc").withColumn("nth", nth).where("nth = 1")
    return met.where(F.col("one").isNull()).select("doc").unionByName(repeated.select("doc")).select(*unpacked("doc", df.columns))
