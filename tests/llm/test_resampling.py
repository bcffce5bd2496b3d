"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb

from tidemark.llm import common
from tidemark.llm.queries import QUERIES
from tidemark.llm.resampling import feature_sums, resample

SF = "/root/testdata/sf0.001"


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(documents, targets):
    per = [(doc, *features(text)) for doc, text in documents]
    s = Counter(b for _, _, f in per for b in f)
    t = Counter(b for text in targets for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))

    rows = []
    for doc, words, found in per:
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, r in enumerate(able[:5 * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_registered_query(spark):
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    targets = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    got = QUERIES["op12_resampling"].run(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert all(kind == "bigint" for _, kind in got.dtypes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(documents, targets)


def test_edges(spark):
    schema = "doc_id bigint, text string, id string, score int, place int"
    long = "Word9 é, x\x00y " * 30
    documents = [(1, None), (2, ""), (3, " .,!"), (4, long), (4, long), (None, long), (5, "A a ÀÉ " * 20), (6, "one two"), *[(i, long) for i in range(10, 60)]]
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in documents], schema)
    for targets in (["a a a", None, long], [], [None]):
        target = spark.createDataFrame([(t,) for t in targets], "text string")
        got = sorted((tuple(r) for r in resample(df, target).collect()), key=repr)
        expected = brute(documents, targets)
        # Equal rows share their places in some order.
        assert got == expected
        assert sum(r[4] is not None for r in got) == 5 * 54 // 100
    empty = resample(df.limit(0), spark.createDataFrame([("a",)], "text string"))
    assert empty.collect() == []


def test_features_of_a_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(300))
    whole = [list(feature_sums(text.encode(), most)) for most in (1, 2, 3, 5)]
    for cut in (1, 2, 7, 64):
        monkeypatch.setattr(common, "CUT_BYTES", cut)
        for most, expected in zip((1, 2, 3, 5), whole, strict=True):
            parts = list(feature_sums(text.encode(), most))
            assert sum(n for n, _ in parts) == expected[0][0] == 300
            assert Counter(x for _, f in parts for x in f) == Counter(expected[0][1])
