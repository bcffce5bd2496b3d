"""The trie against plain Python, with shards so small that most nodes are shared between them."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm.prefix_trie import SearchTree, medians, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, shard string, number int"


def brute(rows, group=20, shares=4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % shares
        base = [] if c is None else own.get(c - c % group, [])
        seq = tuple(base[:h] + turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def least(p):
        return min((c for c in members[p] if c is not None), default=None)

    out, totals = [], {}
    for p in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[p]]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        totals[p] = sum(x[0] for x in below) + (not below), sum(x[1] for x in below) + (len(members[p]) - 1) * words
        listed = ",".join("" if c is None else str(c) for c in sorted(ends[p], key=lambda c: (c is not None, c or 0)))
        out.append((
            least(p), len(p), least(p[:-1]) if p else None, len(members[p]), len(children[p]), *totals[p], hashlib.sha256(listed.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def nodes(spark, rows, **how):
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie(df, **how).collect()), key=repr)


def random_rows(seed, convs, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.choice((1, 2, 2, 3, 5, 9))):
            rows.append((c * rng.choice((1, 3)), t, rng.choice(("user", "assistant")) if texts > 1 else "user", "w " * rng.randrange(texts)))
    return rows


@pytest.mark.parametrize(("seed", "texts", "shard_turns"), [(1, 2, 7), (2, 3, 3), (3, 1, 11), (4, 5, 1000)])
def test_random_conversations(spark, seed, texts, shard_turns):
    rows = random_rows(seed, 60, texts)
    assert nodes(spark, rows, shard_turns=shard_turns) == brute(rows)


def test_one_list_in_most_conversations_fills_several_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400, 20) for t in range(3)] + [(c, t, "user", f"turn {t}") for c in range(1, 120) for t in range(3)]
    found = nodes(spark, rows, shard_turns=20)
    assert found == brute(rows)
    assert max(r[3] for r in found) == len({r[0] for r in rows})


def test_nulls_ties_and_repeats(spark):
    rows = [
        (1, None, "user", "a b"), (1, 0, None, "c"), (1, 0, None, None), (1, 0, "user", "c"), (1, 0, "user", "c"), (2, 1, "user", ""),
        (None, 0, "user", "a b"), (None, None, None, None), (-3, 0, "user", "a b"), (20, 5, "x\ny", "a b"), (21, 5, "x\ny", "a b"), (27, 5, "x\ny", "a b"),
    ]
    for shard_turns in (1, 4, 1000):
        assert nodes(spark, rows, shard_turns=shard_turns) == brute(rows)


def test_a_conversation_of_very_many_turns(spark):
    long, short = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 0][:2]
    rows = [(long, t, "user", f"t{t}") for t in range(5000)] + [(short, t, "user", f"t{t}") for t in range(4000)]
    got = nodes(spark, rows, shard_turns=100)
    assert sorted(r[1] for r in got) == list(range(5001))
    assert [r[5:7] for r in got if r[1] == 0] == [(1, 4000)]


def test_empty_table(spark):
    assert nodes(spark, []) == []


def test_medians_balance_the_tree():
    assert sorted(medians(1000)) == list(range(1000))
    tree = SearchTree()
    for i in medians(1023):
        tree.insert((i,), i, 1, i)

    def height(node):
        return 0 if not node else 1 + max(height(tree.links[3 * node - 2]), height(tree.links[3 * node]))

    assert height(tree.links[0]) == 10
    assert [tree.split[n] for n, done in tree.walk() if n and not done] == list(range(1023))
