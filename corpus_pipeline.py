"""From raw documents to packed training sequences.

``STAGES`` are applied in order. Each takes (spark, docs, sf_dir); ``run`` writes what a
stage returns as Parquet to the shared folder and rereads it as the next one's docs.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import exact_dedup, mixing, packing, quality, simhash  # noqa: E402
from tidemark.llm.common import ready  # noqa: E402
from tidemark.llm.queries import tokenizer_path  # noqa: E402
from tidemark.session import stage  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    ready(spark)
    return quality.drop_low_quality(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest identifier."""
    ready(spark)
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest identifier."""
    ready(spark)
    return simhash.drop_near_copies(docs, shingle=3, distance=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ready(spark)
    return mixing.apply_mix(docs, weights=(1.0, 2.0, 3.0), cap=3.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    ready(spark)
    return packing.pack(docs, tokenizer_path(), length=4096, end_id=2)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

# Fingerprints, random mixing and tokens are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
