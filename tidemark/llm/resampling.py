"""Importance resampling: draw documents that look like a target collection.

1. Words: a table of 256 bytes lower-cases A-Z and blanks every separator in UTF-8, and
   ``bytes.split`` cuts at the blanks. A long text is cut a megabyte at a time.
2. Features: runs of 1 to ``most`` words joined by a space, by bucket of their CRC-32. The
   checksum of a run is the seed from which that of the run longer by one word goes on, so
   no run is put together.
3. Counts: a Counter per task, at most one row per bucket of it, added up by bucket. All
   documents and all target texts are counted.
4. Weight: the sum of the gains of a document's features, and noise out of its identifier.
   Documents are ranked by range of (score, identifier), so that no task sorts them all.

Defined results: null text has no words; a document without words has weight 0; one with
fewer than ``least_words`` words is never drawn; a null identifier is hashed as empty text
and goes before others in ties; repeated rows are ranked each; with an empty target all
counts of it are zero; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import named, ready, word_runs
from tidemark.operators.numbering import number_rows
from tidemark.session import stage

BUCKETS = 10_000
MOST_WORDS = 3


def feature_sums(body: bytes, most: int) -> Iterator[tuple[int, list[int]]]:
    """(words, checksums of the features that end in them) for each part of a text."""
    tail: list[bytes] = []
    for words in word_runs(body):
        held, run = len(tail), tail + words
        spaced = [b" " + w for w in run]
        sums = list(map(zlib.crc32, run))
        found = sums[held:]
        for n in range(1, most):
            # The checksum of n words is the seed for the word after them.
            sums = list(map(zlib.crc32, spaced[n:], sums))
            found += sums[max(0, held - n):]
        yield len(words), found
        tail = run[1 - most:] if most > 1 else []


def bucket_counts(df: DataFrame, text_col: str, buckets: int, most: int) -> dict[int, int]:
    """Features per bucket over all rows; at most ``buckets`` entries."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for part in parts:
            for body in part.column(0).to_pylist():
                for _, sums in feature_sums(body or b"", most):
                    seen.update((np.array(sums, dtype=np.int64) % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["bucket", "n"])

    counted = df.select(named(text_col).cast("string").cast("binary").alias("body")).mapInArrow(count, "bucket bigint, n bigint")
    return {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Per bucket: floor(1000 ln) of how much more frequent it is in the target, smoothed by one each."""
    all_corpus, all_target = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * all_corpus / ((corpus.get(b, 0) + 1.0) * all_target))) for b in range(buckets)
    ], dtype=np.int64)


def weigh(df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, most: int) -> DataFrame:
    """id, n_words, n_features, weight."""
    buckets = len(gain)
    source = df.select(named(id_col).alias("id"), named(text_col).cast("string").cast("binary").alias("body"))

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for body in part.column("body").to_pylist():
                words = features = weight = 0
                for n, sums in feature_sums(body or b"", most):
                    words, features = words + n, features + len(sums)
                    weight += int(gain[np.array(sums, dtype=np.int64) % buckets].sum())
                rows.append((words, features, weight))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", "n_words", "n_features", "weight"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(add, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(identifier: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u out of the first 32 bits of SHA-256 of ``seed:identifier``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, most: int = MOST_WORDS, least_words: int = 20, percent: int = 5, seed: int = 42,
) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (null where it is not drawn)."""
    ready(df.sparkSession)
    gain = gains(bucket_counts(df, text_col, buckets, most), bucket_counts(target, target_text, buckets, most), buckets)
    scored = stage(weigh(df, gain, id_col, text_col, most).withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "weights")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = number_rows(able.withColumn("falling", -F.col("score")), ["falling", "id"], name="place", start=1)
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    out = ["id", "n_features", "weight", "score", "rank"]
    return ranked.withColumn("rank", rank).select(*out).unionByName(short.select(*out)).withColumnRenamed("id", id_col)
