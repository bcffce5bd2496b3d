"""Exact cosine search that leaves out what cannot match before it is read.

Angles between directions obey the triangle inequality: a vector whose angle to a pivot differs from
the query's by more than the angle that is asked for is too far from the query. So vectors are stored
by their nearest pivot and, within it, by rings of angle, a folder each. A search names the folders
that may hold a match, reads those, and scores what is in them as ``operators.vectors`` does: results
are the same as over the whole table. How much is left out depends on the data: clustered vectors
have narrow rings, random directions of many dimensions do not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.vectors import _matrix, vector_range, vector_topk

# Pivots, and rows of the sample that they are chosen from.
PIVOTS = 64
SAMPLE_ROWS = 4096
# Width of a ring in radians, and what rounded scores may be off.
RING = 0.05
SLACK = 1e-4
FILE_BYTES = 1 << 27
PIVOT, RING_NO, ANGLE = "_pivot", "_ring", "_angle"


def _chosen(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Unit vectors far from each other: each next one is that which is farthest from those before it."""
    picked = [0]
    nearest = vectors @ vectors[0]
    while len(picked) < min(pivots, len(vectors)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        picked.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    return vectors[picked]


@dataclass(frozen=True)
class VectorIndex:
    """An index that ``build`` wrote. ``cells`` has the rows of each (pivot, ring)."""

    spark: SparkSession
    path: str
    vec_col: str
    schema: T.StructType
    pivots: np.ndarray
    cells: dict[tuple[int, int], int]

    @classmethod
    def build(cls, df: DataFrame, id_col: str, vec_col: str, path: str, pivots: int = PIVOTS, sample_rows: int = SAMPLE_ROWS) -> VectorIndex:
        """Write all rows of ``df`` by pivot and ring. Pivots come from a bounded sample; every row is stored.

        Vectors that are missing, zero or of another size than the first of the sample are stored apart: no
        search finds them. A ring with very many rows is written by several tasks.
        """
        spark = df.sparkSession
        # The rows with the smallest hashes: a sample that a repeated task finds again.
        sample = df.where(F.size(vec_col) > 0).select(vec_col).orderBy(F.xxhash64(vec_col)).limit(sample_rows).toArrow()
        column = sample.column(0).combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.float64()))
        dim = len(column[0]) if len(column) else 0
        units = _matrix(column, dim)[0] if dim else np.zeros((0, 0))
        chosen = _chosen(units, pivots) if len(units) else units

        @F.arrow_udf(T.StructType([T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())]))
        def place(vectors: pa.Array) -> pa.Array:
            number, angle = np.full(len(vectors), -1, dtype=np.int32), np.full(len(vectors), np.nan)
            if len(chosen):
                rows, good = _matrix(vectors, dim)
                near = rows @ chosen.T
                number[good] = near.argmax(axis=1)
                angle[good] = np.arccos(np.clip(near.max(axis=1), -1.0, 1.0)) if len(rows) else []
            return pa.StructArray.from_arrays([pa.array(number), pa.array(angle, mask=number < 0)], names=["pivot", "angle"])

        placed = df.withColumn("_place", place(F.col(vec_col))).select(
            "*", F.col("_place.pivot").alias(PIVOT), F.col("_place.angle").alias(ANGLE), F.coalesce(F.floor(F.col("_place.angle") / RING), F.lit(-1)).cast("int").alias(RING_NO),
        ).drop("_place")
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = max(1, min(size // FILE_BYTES + 1, parts * 64))
        dealt = placed.repartitionByRange(files, PIVOT, RING_NO, ANGLE, F.xxhash64(id_col)).sortWithinPartitions(PIVOT, RING_NO, ANGLE)
        dealt.write.partitionBy(PIVOT, RING_NO).parquet(f"{path}/data")
        rows = [(i, [float(x) for x in p]) for i, p in enumerate(chosen)]
        spark.createDataFrame(rows, "pivot int, unit array<double>").coalesce(1).write.parquet(f"{path}/pivots")
        return cls.open(spark, path, vec_col, df.schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str, vec_col: str, schema: T.StructType) -> VectorIndex:
        known = spark.read.schema("pivot int, unit array<double>").parquet(f"{path}/pivots").orderBy("pivot").collect()
        made = cls(spark, path, vec_col, schema, np.array([r["unit"] for r in known]), {})
        # Counts come from the footers; at most one row per folder.
        cells = made._stored().groupBy(PIVOT, RING_NO).count().collect()
        made.cells.update({(r[PIVOT], r[RING_NO]): r["count"] for r in cells})
        return made

    def _stored(self) -> DataFrame:
        extra = T.StructType.fromDDL(f"{ANGLE} double, {PIVOT} int, {RING_NO} int")
        return self.spark.read.schema(T.StructType([*self.schema.fields, *extra.fields])).parquet(f"{self.path}/data")

    def _angles(self, query: Sequence[float]) -> np.ndarray:
        wanted = np.asarray(query, dtype=np.float64)
        length = float(np.linalg.norm(wanted))
        if not math.isfinite(length) or length == 0.0:
            raise ValueError("the query vector has no direction")
        if not len(self.pivots) or len(wanted) != self.pivots.shape[1]:
            return np.zeros(0)
        return np.arccos(np.clip(self.pivots @ (wanted / length), -1.0, 1.0))

    def _of(self, cells: Sequence[tuple[int, int]]) -> DataFrame:
        """The rows of some cells. Only their folders are read."""
        rings: dict[int, list[int]] = {}
        for pivot, ring in cells:
            rings.setdefault(pivot, []).append(ring)
        chosen = [(F.col(PIVOT) == p) & F.col(RING_NO).isin(sorted(r)) for p, r in sorted(rings.items())]
        return self._stored().where(reduce(or_, chosen, F.lit(False))).select(*self.schema.names)

    def _least(self, query: Sequence[float]) -> dict[tuple[int, int], float]:
        """For each cell the least angle that a vector of it can have to the query."""
        angles = self._angles(query)
        return {
            (pivot, ring): max(0.0, ring * RING - angles[pivot], angles[pivot] - (ring + 1) * RING)
            for pivot, ring in self.cells if 0 <= pivot < len(angles)
        }

    def near(self, query: Sequence[float], radius: float) -> DataFrame:
        """All rows that can have a similarity of at least ``radius``, and others of their cells."""
        far = math.acos(min(1.0, max(-1.0, radius))) + SLACK
        return self._of([cell for cell, least in self._least(query).items() if least <= far])

    def range(self, query: Sequence[float], radius: float, expr: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
        """As ``vector_range``."""
        return vector_range(self.near(query, radius), self.vec_col, query, radius, expr, fields)

    def topk(self, query: Sequence[float], k: int, id_col: str, expr: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
        """As ``vector_topk``: the nearest cells give a bound for the k-th score, and that bound the cells to look at."""
        first, held = [], 0
        for cell, _ in sorted(self._least(query).items(), key=lambda c: (c[1], c[0])):
            if held >= 2 * k:
                break
            first.append(cell)
            held += self.cells[cell]
        scores = [r["score"] for r in vector_topk(self._of(first), self.vec_col, query, k, id_col, expr, [id_col]).select("score").collect()]
        bound = min(scores) if len(scores) == k else -1.0
        return vector_topk(self.near(query, bound), self.vec_col, query, k, id_col, expr, fields)
