"""Expectation-maximisation document by document, and the linear score, in plain Python."""

import math

import duckdb
import numpy as np

from tidemark.llm import quality
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_em(documents, rounds=100):
    """Posteriors of single documents (tuples of votes), with no patterns and no matrices."""
    labellers = range(len(documents[0]))
    alarm, find, share = [0.02 for _ in labellers], [0.33 for _ in labellers], 0.85
    posterior = []
    for _ in range(rounds):
        posterior = []
        for votes in documents:
            good, bad = math.log(share), math.log(1 - share)
            for j, vote in enumerate(votes):
                if vote == quality.BAD:
                    good, bad = good + math.log(alarm[j]), bad + math.log(find[j])
                elif vote == quality.GOOD:
                    good, bad = good + math.log(1 - alarm[j]), bad + math.log(1 - find[j])
            posterior.append(1 / (1 + math.exp(min(500, max(-500, bad - good)))))
        for j in labellers:
            said_bad = [(p, v[j]) for p, v in zip(posterior, documents, strict=True) if v[j] in (quality.BAD, quality.GOOD)]
            alarm[j] = (sum(p for p, v in said_bad if v == quality.BAD) + 0.02) / (sum(p for p, _ in said_bad) + 1)
            find[j] = (sum(1 - p for p, v in said_bad if v == quality.BAD) + 0.33) / (sum(1 - p for p, _ in said_bad) + 1)
        share = min(max((sum(posterior) + 1) / (len(documents) + 2), 1e-6), 1 - 1e-6)
    return posterior


def test_posteriors_and_scores_of_the_whole_table(spark):
    texts = {d: (t or "").encode() for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}
    table = quality._class_table()
    profiles = {d: quality.profile(body, table) for d, body in texts.items()}
    votes = {d: quality.votes(stats) for d, (stats, _) in profiles.items()}
    expected = dict(zip(votes, plain_em(list(votes.values())), strict=True))
    got = {r.doc_id: r for r in QUERIES["op4_quality_classifier"].run(spark, SF).collect()}
    assert set(got) == set(texts)
    assert max(abs(got[d].posterior - expected[d]) for d in texts) < 1e-6

    # All documents are fitted to here, each with weight one: the same regression, feature by feature.
    rows = sorted(texts)
    place = np.zeros((len(rows), quality.FEATURES))
    for i, d in enumerate(rows):
        for at, weight in zip(profiles[d][1][0].astype(int), profiles[d][1][1], strict=True):
            place[i, at] += weight
    y = np.array([expected[d] for d in rows])
    rarer = max(0.5, min(y.sum(), (1 - y).sum()))
    theta, first, second = np.zeros(quality.FEATURES + 1), 0.0, 0.0
    wide = np.hstack([place, np.ones((len(rows), 1))])
    for t in range(1, 301):
        p = 1 / (1 + np.exp(-np.clip(wide @ theta, -30, 30)))
        slope = wide.T @ ((p - y) / rarer) + np.append(1e-4 * theta[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    scores = 1 / (1 + np.exp(-np.clip(wide @ theta, -60, 60)))
    # Single precision there, double here.
    off = [abs(got[d].score - s) for d, s in zip(rows, scores, strict=True)]
    assert np.median(off) < 0.01 and max(off) < 0.1
    assert np.mean([got[d].kept == (s >= quality.THRESHOLD) for d, s in zip(rows, scores, strict=True)]) > 0.99
