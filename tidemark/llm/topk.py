"""Exact top-k by inner product, with buckets of vectors of like length.

Vectors are grouped by length (norm) into buckets, and a bucket is packed into blocks
of at most ``BLOCK`` vectors, longest first: a bucket that holds most vectors is just
more blocks. Queries are packed into blocks of ``QUERY_BLOCK``. The queries are a stated
set: about ``QUERY_BYTES`` of them at a time go to all tasks, which read the blocks where
they lie, so the vectors are shuffled once, when they are packed, and only hits after that.

A first round runs every query against the longest block of its dimension; its k-th
score is a lower bound for the final one. In the second round the bound, divided by
the lengths of the query and of the longest vector of a block, is the cosine that
block must reach (the local threshold):

* above 1: nothing in the block can do; it is not even looked at if that holds for all
  queries of theirs;
* low: length pruning. Only vectors long enough to reach the bound are looked at;
* high: coordinate pruning. A unit vector within that cosine of the query has each of
  its coordinates in a known range; the tightest of the query's largest coordinates
  is looked up in the block's sorted column.

What is left is multiplied exactly, in integers, or in doubles where all products
stay below 2^53. Pruning only drops vectors that cannot be among the best.

Defined results: vectors that are null or hold null, NaN or infinite components take
no part; vectors of different dimension are not compared; a query's own row is no
candidate, another row with its identifier is; ties go to the smaller identifier, null
last; fewer than k candidates give fewer rows; scores beyond 64 bits are clipped; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import named
from tidemark.session import stage

BLOCK = 8192
QUERY_BLOCK = 512
# Buckets: lengths that differ by less than this factor share one.
GROWTH = 1.1
# From this local threshold on, coordinates prune better than lengths.
HIGH_COSINE = 0.6
COORDINATES = 3
# Bytes of queries that all tasks get at once, and dimensions whose longest blocks do.
QUERY_BYTES = 1 << 25
SEED_DIMENSIONS = 16
EXACT = float(1 << 53)
SLACK = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) for every component; null unless all are finite."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(good, values)


def _matrix(group: pd.DataFrame) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype="<i8") for v in group["vec"]], dtype=np.int64).reshape(len(group), -1)


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``q`` and ``v``."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), dtype=np.int64)
    qf, vf = q.astype(float), v.astype(float)
    if np.linalg.norm(qf, axis=1).max() * np.linalg.norm(vf, axis=1).max() < EXACT / 2:
        return (qf @ vf.T).astype(np.int64)
    exact = q.astype(object) @ v.astype(object).T
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


def _packed_blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per block: uids, their places by (id, null last, uid), and vectors as bytes, longest vector first."""

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["no_id", "some_id", "uid"]).assign(place=np.arange(len(group)))
        group = group.sort_values(["norm", "uid"], ascending=[False, True])
        return pd.DataFrame({
            **{name: [value] for name, value in zip(keys, key, strict=True)},
            "uids": [group["uid"].to_numpy(np.int64).tobytes()], "places": [group["place"].to_numpy(np.int64).tobytes()],
            "vecs": [b"".join(group["vec"])], "rows": [len(group)],
            "most": [float(group["norm"].max())],
        })

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{name} {kinds[name]}" for name in keys) + ", uids binary, places binary, vecs binary, rows bigint, most double"
    # A null would turn whole numbers into floating ones.
    some_id = F.coalesce("id", F.lit(0).cast(kinds["id"]))
    rows = rows.withColumns({"no_id": F.col("id").isNull(), "some_id": some_id}).drop("id")
    return rows.groupBy(*keys).applyInPandas(one, schema)


class _Block:
    def __init__(self, uids: bytes, places: bytes, vecs: bytes, rows: int):
        self.uids = np.frombuffer(uids, dtype="<i8")
        self.places = np.frombuffer(places, dtype="<i8")
        self.vecs = np.frombuffer(vecs, dtype="<i8").reshape(rows, -1)
        self.norms = np.linalg.norm(self.vecs.astype(float), axis=1)
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def column(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Places by coordinate f of the unit vectors, and those coordinates."""
        if f not in self.sorted:
            unit = self.vecs[:, f] / np.maximum(self.norms, 1.0)
            order = np.argsort(unit, kind="stable")
            self.sorted[f] = order, unit[order]
        return self.sorted[f]

    def candidates(self, q: np.ndarray, q_norm: float, bound: float) -> np.ndarray | slice:
        """Places that may score at least ``bound`` against ``q``."""
        if not np.isfinite(bound) or bound <= 0 or q_norm == 0:
            return slice(None)
        cosine = bound / (q_norm * max(self.norms[0], 1.0)) - SLACK
        if cosine > 1:
            return slice(0, 0)
        # Lengths fall: those from here on are too short for any direction.
        long_enough = int(np.searchsorted(-self.norms, -(bound / q_norm) * (1 - SLACK), side="right"))
        if cosine < HIGH_COSINE or not self.norms[-1] > 0:
            return slice(0, long_enough)
        unit, best = q / q_norm, None
        for f in np.argsort(-np.abs(unit))[:COORDINATES]:
            order, values = self.column(int(f))
            reach = np.sqrt(max(0.0, 1 - cosine**2) * max(0.0, 1 - unit[f] ** 2)) + SLACK
            # Beyond the range the angle is too wide, unless the cosine of this axis alone suffices.
            low = cosine * unit[f] - reach if unit[f] > -cosine else -1.0
            high = cosine * unit[f] + reach if unit[f] < cosine else 1.0
            if unit[f] >= cosine:
                high = 1.0
            if unit[f] <= -cosine:
                low = -1.0
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if best is None or b - a < len(best):
                best = order[a:b]
        return best[best < long_enough]


def _best(uids: np.ndarray, places: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores; of those that tie with the last of them, the first by place."""
    other = uids != own
    uids, places, scores = uids[other], places[other], scores[other]
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, ties = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        room = k - len(above)
        if len(ties) > room:
            ties = ties[np.argpartition(places[ties], room - 1)[:room]]
        kept = np.concatenate((above, ties))
        uids, scores = uids[kept], scores[kept]
    return uids, scores


def _hits(block: _Block, q_uids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> pd.DataFrame | None:
    """(query uid, uid, score): per query the k best of a block."""
    q_norms = np.linalg.norm(queries.astype(float), axis=1)
    out = []
    places = [block.candidates(queries[i].astype(float), q_norms[i], bounds[i]) for i in range(len(queries))]
    # Queries that leave a prefix share one multiplication.
    prefix = [i for i, p in enumerate(places) if isinstance(p, slice)]
    longest = max([len(block.uids[places[i]]) for i in prefix], default=0)
    together = _products(queries[prefix], block.vecs[:longest]) if longest else None
    for at, i in enumerate(prefix):
        n = len(block.uids[places[i]])
        if n:
            out.append((q_uids[i], *_best(block.uids[:n], block.places[:n], together[at, :n], q_uids[i], k)))
    for i, p in enumerate(places):
        if not isinstance(p, slice) and len(p):
            out.append((q_uids[i], *_best(block.uids[p], block.places[p], _products(queries[i:i + 1], block.vecs[p])[0], q_uids[i], k)))
    if not out:
        return None
    return pd.DataFrame({
        "q_uid": np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64),
        "uid": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out]),
    })


SCORED = "q_uid bigint, uid bigint, score bigint"


def _scored(rows: DataFrame, work) -> DataFrame:
    """(query uid, uid, score): per query and block the k best."""
    return rows.mapInPandas(work, SCORED)


def _seeded(pairs: DataFrame, k: int) -> DataFrame:
    """Queries beside one block each, without bounds yet."""

    def work(parts):
        for part in parts:
            for row in part.itertuples(index=False):
                queries = np.frombuffer(row.q_vecs, dtype="<i8").reshape(row.q_rows, -1)
                found = _hits(
                    _Block(row.uids, row.places, row.vecs, row.rows), np.frombuffer(row.q_uids, dtype="<i8"), queries, np.full(row.q_rows, -np.inf), k,
                )
                if found is not None:
                    yield found

    return _scored(pairs, work)


def _against_all(blocks: DataFrame, asked: list[dict], k: int) -> DataFrame:
    """All blocks, where they lie, against some blocks of queries (at most ``QUERY_BYTES`` of them), which every task gets."""
    shared = blocks.sparkSession.sparkContext.broadcast(asked)

    def work(parts):
        for part in parts:
            for row in part.itertuples(index=False):
                block = None
                for q in shared.value:
                    # The local threshold: no vector of the block is long enough for any query of theirs.
                    if q["q_dim"] != row.dim or q["ease"] > row.most * (1 + SLACK):
                        continue
                    block = block or _Block(row.uids, row.places, row.vecs, row.rows)
                    queries = np.frombuffer(q["q_vecs"], dtype="<i8").reshape(q["q_rows"], -1)
                    found = _hits(block, np.frombuffer(q["q_uids"], dtype="<i8"), queries, np.frombuffer(q["q_bounds"], dtype="<f8"), k)
                    if found is not None:
                        yield found

    least = min(q["ease"] for q in asked)
    near = blocks.where((F.col("most") * (1 + SLACK) >= F.lit(float(least))) & F.col("dim").isin(sorted({q["q_dim"] for q in asked})))
    return _scored(near.select("dim", "most", "rows", "uids", "places", "vecs"), work)


def topk_inner(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024, query_every: int = 100,
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best candidates of every query (rows whose id is divisible by ``query_every``): query_id, rank, vec_id, score."""
    spark = df.sparkSession
    # A block is some megabytes (8192 vectors of 64 components are four), and a batch holds sixteen.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    known = (
        df.select(named(id_col).alias("id"), quantised(named(vector_col), scale).alias("vec")).where("vec is not null")
        .withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
        .withColumn("dim", F.size("vec")).withColumn("uid", F.monotonically_increasing_id())
        .withColumn("bucket", F.floor(F.log(F.greatest("norm", F.lit(1.0))) / F.log(F.lit(GROWTH))).cast("int"))
    )
    vectors = stage(known, "vectors")
    sizes = vectors.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / block).alias("parts"))
    as_bytes = _vector_bytes(vectors.join(sizes, ["dim", "bucket"]).withColumn("part", F.pmod(F.xxhash64("uid"), "parts")))
    blocks = stage(_packed_blocks(as_bytes, ["dim", "bucket", "part"]).withColumn("block", F.monotonically_increasing_id()), "blocks")

    chosen = vectors.where(F.col("id") % query_every == 0)
    q_sizes = chosen.groupBy("dim").agg(F.ceil(F.count("*") / query_block).alias("parts"))
    q_bytes = _vector_bytes(chosen.join(q_sizes, "dim").withColumn("part", F.pmod(F.xxhash64("uid"), "parts")))
    queries = stage(_packed_blocks(q_bytes, ["dim", "part"]).select(
        F.col("dim").alias("q_dim"), F.col("part").alias("q_part"), F.col("uids").alias("q_uids"), F.col("vecs").alias("q_vecs"), F.col("rows").alias("q_rows"),
    ), "queries")

    # First round: the longest block of each dimension, which is sent to the queries (a dimension is one block).
    marks = blocks.select("dim", "block", "most", "rows")
    seeds = marks.groupBy("dim").agg(F.max(F.struct("most", "block")).getField("block").alias("block"))
    seeds = blocks.select("block", "uids", "places", "vecs", "rows").join(F.broadcast(seeds), "block")
    seeds = F.broadcast(seeds) if chosen.select("dim").distinct().count() <= SEED_DIMENSIONS else seeds
    spread = queries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "q_dim", "q_part")
    first = _seeded(spread.join(seeds, queries["q_dim"] == seeds["dim"]), k)
    nth = F.row_number().over(Window.partitionBy("q_uid").orderBy(F.col("score").desc()))
    bound = first.withColumn("nth", nth).where(F.col("nth") == k).select("q_uid", F.col("score").alias("bound"))
    bounded = stage(_with_bounds(queries, bound), "bounded")

    # Second round: the queries go to the blocks, some at a time, so that no block is ever moved.
    amount = F.octet_length("q_vecs") + F.octet_length("q_bounds") + F.octet_length("q_uids")
    turns = max(1, -(-(bounded.agg(F.sum(amount)).first()[0] or 0) // QUERY_BYTES))
    scored = spark.createDataFrame([], SCORED)
    for turn in range(turns):
        asked = [r.asDict() for r in bounded.where(F.pmod(F.xxhash64("q_dim", "q_part"), F.lit(turns)) == turn).collect()]
        if asked:
            scored = scored.unionByName(_against_all(blocks, asked, k))
    scored = stage(scored, "scored")
    ids = vectors.select("uid", "id")
    better = Window.partitionBy("q_uid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "uid")
    ranked = scored.join(ids, "uid").withColumn("rank", F.row_number().over(better)).where(F.col("rank") <= k)
    query_ids = chosen.select(F.col("uid").alias("q_uid"), F.col("id").alias("query_id"))
    return ranked.join(query_ids, "q_uid").select("query_id", "rank", F.col("id").alias(id_col), "score")


def _vector_bytes(df: DataFrame) -> DataFrame:
    """Vectors as little-endian bytes, which pandas can hand on without a list per row."""

    def work(parts):
        for part in parts:
            yield part.assign(vec=[np.asarray(v, dtype="<i8").tobytes() for v in part["vec"]])

    schema = ", ".join(f"`{f.name}` {'binary' if f.name == 'vec' else f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(work, schema)


def _with_bounds(queries: DataFrame, bounds: DataFrame) -> DataFrame:
    """Query blocks with their bounds; ``ease`` is the least length that any of their queries can use."""

    def listed(parts):
        for part in parts:
            for row in part.itertuples(index=False):
                vecs = np.frombuffer(row.q_vecs, dtype="<i8").reshape(row.q_rows, -1)
                yield pd.DataFrame({
                    "q_dim": row.q_dim, "q_part": row.q_part, "place": np.arange(row.q_rows), "q_uid": np.frombuffer(row.q_uids, dtype="<i8"),
                    "q_norm": np.linalg.norm(vecs.astype(float), axis=1),
                })

    each = queries.mapInPandas(listed, "q_dim int, q_part bigint, place bigint, q_uid bigint, q_norm double").join(bounds, "q_uid", "left")
    ease = F.when((F.col("bound") > 0) & (F.col("q_norm") > 0), F.col("bound") / F.col("q_norm")).otherwise(0.0)
    per_block = each.groupBy("q_dim", "q_part").agg(
        F.min(ease).alias("ease"),
        F.array_sort(F.collect_list(F.struct("place", F.coalesce(F.col("bound").cast("double"), F.lit(float("-inf"))).alias("bound")))).alias("bounds"),
    )

    @F.pandas_udf("binary")
    def as_bytes(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.asarray(v, dtype="<f8").tobytes())

    return queries.join(per_block, ["q_dim", "q_part"]).withColumn("q_bounds", as_bytes(F.col("bounds.bound"))).drop("bounds")
