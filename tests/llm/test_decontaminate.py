"""Phrases and proximity matches against plain Python."""

import random
import re

import numpy as np
import pytest

from tidemark.llm.decontaminate import Queries, Shard, decontaminate, search

DOCS = "doc_id bigint, text string, uid string, window int, id int"
ITEMS = "item_id bigint, text string, words string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(text, size):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def brute(documents, items, size, slop):
    listed = [("" if i is None else str(i), v) for i, t in items for v in windows(t, size)]
    out = []
    for doc, text in documents:
        w = words(text)
        hit, exact, near = set(), set(), set()
        for item, v in listed:
            for at in range(len(w) - len(v) + 1):
                if tuple(w[at:at + len(v)]) == v:
                    hit |= set(range(at, at + len(v)))
                    exact.add(item)
            if any(set(v) <= set(w[at:at + len(v) + slop]) for at in range(len(w))):
                near.add(item)
        starts = sorted(p for p in hit if p - 1 not in hit)
        ends = sorted(p + 1 for p in hit if p + 1 not in hit)
        out.append((doc, len(w), list(zip(starts, ends, strict=True)), len(hit), sorted(exact), sorted(near)))
    return sorted(out, key=repr)


def found(spark, documents, items, **how):
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in documents], DOCS).repartition(3)
    bench = spark.createDataFrame([(*i, "clash") for i in items], ITEMS)
    rows = decontaminate(df, bench, **how).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.n_hit, r["items"], r.near_items) for r in rows), key=repr)


@pytest.mark.parametrize(("seed", "vocabulary", "size", "slop"), [(1, 4, 3, 2), (2, 30, 4, 3), (3, 12, 5, 0), (4, 2, 6, 1)])
def test_random_texts(spark, seed, vocabulary, size, slop):
    rng = random.Random(seed)

    def text(most):
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(most)))

    items = [(i % 9, text(12)) for i in range(12)]
    documents = [(i, text(80)) for i in range(50)]
    expected = brute(documents, items, size, slop)
    assert found(spark, documents, items, window=size, slop=slop) == expected
    # Small shards, and the windows in several blocks.
    assert found(spark, documents, items, window=size, slop=slop, shard_words=60, block_windows=8) == expected


def test_edges(spark):
    long = "the quick brown fox jumps over the lazy dog again"
    items = [(1, long), (1, long), (2, long.upper() + "!"), (3, None), (4, ""), (5, "É x"), (None, "lone"), (6, "a a a a a a a a a a a a")]
    documents = [
        (1, None), (2, ""), (3, long), (3, long), (None, f"so {long}, {long}"), (4, "the quick brown fox lazy dog over jumps again"), (5, "x É x"),
        (6, "LONE lone"), (7, "a " * 200), (8, "a " * 9), (9, ("pad " * 5000) + long + (" pad" * 5000)), (10, "the quick brown fox"), (11, "The-quick:brown fox"),
    ]
    expected = brute(documents, items, 10, 5)
    assert found(spark, documents, items) == expected
    assert found(spark, documents, items, shard_words=1) == expected
    assert found(spark, documents, []) == brute(documents, [], 10, 5)
    assert found(spark, [], items) == []


def test_only_words_that_can_match_are_posted():
    queries = Queries([0, 1], ["a b c d", "e"], 4, 1)
    codes = queries.codes(b"a b x x x a b c x d e x x x d c b a")
    terms, places = queries.postings(codes)
    # a and b at the start have too few others near them; e alone is a window.
    assert sorted(places.tolist()) == [5, 6, 7, 9, 10, 14, 15, 16, 17]
    shard = Shard(terms, places, len(codes), len(queries.terms))
    rows, at, near_rows, near_at = search(queries, shard)
    assert list(zip(rows.tolist(), at.tolist(), strict=True)) == [(1, 10)]
    assert {0, 1} == set(near_rows.tolist())
    assert np.all(codes[near_at] >= 0)
