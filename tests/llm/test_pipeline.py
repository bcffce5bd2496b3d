"""``run`` of the pipeline, each stage against plain Python on what the stage before it kept."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import xxhash

from tidemark.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of ``documents`` and of each stage, by name."""
    frames = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}
    keep = corpus_pipeline.stage

    def kept(df, name):
        out = keep(df, name)
        frames[name.removeprefix("pipeline-")] = out
        return out

    corpus_pipeline.stage = kept
    try:
        last = corpus_pipeline.run(spark, SF)
    finally:
        corpus_pipeline.stage = keep
    assert list(frames) == ["documents", *[name for name, _ in corpus_pipeline.STAGES]]
    assert last is frames["packing"]
    for name in ("quality", "exact_dedup", "near_dedup", "mixing"):
        assert frames[name].columns == frames["documents"].columns
    return {name: [tuple(r) for r in df.collect()] if name != "packing" else df.collect() for name, df in frames.items()}


def test_quality_drops_bad_documents_only(stages):
    before, after = Counter(stages["documents"]), Counter(stages["quality"])
    assert not after - before and sum(after.values()) < sum(before.values())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    left = {r[0] for r in stages["quality"]}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in left for d in good) >= 0.98 * len(good)
    assert sum(d in left for d in bad) <= 0.1 * len(bad)


def test_exact_dedup_keeps_the_largest_identifier(stages):
    best = {}
    for row in stages["quality"]:
        text = row[1] or ""
        if text not in best or row[0] > best[text][0]:
            best[text] = row
    assert Counter(stages["exact_dedup"]) == Counter(best.values())


def fingerprint(text):
    words = re.findall(SPACE, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    bits = np.zeros(64, dtype=int)
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), seed=42)
        bits += [(h >> b) & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if runs and 2 * bits[b] > len(runs))


def test_near_dedup_keeps_one_of_each_group(stages):
    rows = stages["exact_dedup"]
    prints = [fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[find(i)].append(row)
    assert Counter(stages["near_dedup"]) == Counter(min(g, key=lambda r: r[0]) for g in groups.values())


def words(row):
    return len(re.findall(SPACE, row[1] or ""))


def test_mixing_meets_its_targets(stages):
    before = {r[0]: r for r in stages["near_dedup"]}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before.values():
        sizes[r[3]] += words(r)
    copies = defaultdict(int)
    for r in stages["mixing"]:
        # A copy may be cut: then it holds the first words of the text.
        assert (before[r[0]][1] or "").startswith((r[1] or "").rstrip())
        copies[r[0]] += words(r)
        taken[r[3]] += words(r)
    assert all(n <= 3 * words(before[d]) for d, n in copies.items())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    rest, free, target = float(sum(sizes.values())), set(names), {}
    while True:
        share = {s: rest * weights[s] / sum(weights[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
    target |= share
    for s in names:
        most = max(words(r) for r in before.values() if r[3] == s)
        assert abs(taken[s] - target[s]) <= most


def test_packing_holds_each_token_once(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    for r in stages["mixing"]:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for at in range(0, len(ids), 4096):
            window = ids[at:at + 4096]
            expected[r[0], at, len(window), zlib.crc32(window.tobytes()), len(ids)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in stages["packing"]) == expected
    sequences = defaultdict(list)
    for p in stages["packing"]:
        sequences[p.sequence_id].append((p.offset, p.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    used = sum(p.length for p in stages["packing"])
    assert used >= 0.9 * 4096 * (len(sequences) - 1)
