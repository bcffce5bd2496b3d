"""Queries that go to the blocks in several turns, and what is shuffled then."""

import numpy as np
import pytest

from tidemark.llm import topk


def brute(rows, k, every):
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows}
    found = set()
    for q in whole:
        if q % every == 0:
            best = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:k]
            found |= {(q, rank, i, -score) for rank, (score, i) in enumerate(best, 1)}
    return found


@pytest.mark.parametrize("query_bytes", [1, 2000, 1 << 25])
def test_turns_change_nothing(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] * rng.uniform(0.2, 3) + rng.normal(size=6) * 0.1).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = topk.topk_inner(df, k=6, query_every=9, block=50, query_block=8)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == brute(rows, 6, 9)


def test_blocks_stay_where_they_lie(spark, monkeypatch):
    plans, scored = [], topk._scored

    def kept(rows, work):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return scored(rows, work)

    monkeypatch.setattr(topk, "_scored", kept)
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.random(4).tolist()) for i in range(200)], "vec_id bigint, embedding array<double>")
    topk.topk_inner(df, k=3, query_every=10, block=40).count()
    # The first round sends one block to the queries, the second reads the blocks: no pair of blocks is shuffled.
    assert "Exchange" not in plans[1] and "PushedFilters" in plans[1]
    assert "SortMergeJoin" not in plans[0]
