"""Whole license texts: versions told apart, and diagonals against a plain search."""

import random

from tidemark.llm import licenses
from tidemark.llm.license_texts import TEXTS


def scan(spark, texts, **how):
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), **how).collect()
    return {r.doc_id: r for r in rows}


def test_each_text_is_found_by_its_own_label(spark):
    families = {label for _, label in TEXTS}
    assert len(families) >= 20
    got = scan(spark, [f"Some code here.\n{text}\n and so on, x = 1" for text, _ in TEXTS])
    for i, (_, label) in enumerate(TEXTS):
        assert label in got[i].labels.split(","), (label, got[i].labels)
        # A sibling of the same family that fits less well gives way.
        stem = label.split("-")[0]
        others = {x for x in got[i].labels.split(",") if x.startswith(f"{stem}-") and any(c.isdigit() for c in x)}
        assert others <= {label}, (label, got[i].labels)


def test_a_word_more_or_less_changes_no_label(spark):
    rng = random.Random(2)
    changed = []
    for text, _ in TEXTS:
        words = text.split()
        for _ in range(max(1, len(words) // 60)):
            at = rng.randrange(5, len(words) - 5)
            words[at:at + 1] = rng.choice(([], [words[at], "really"]))
        changed.append(" ".join(words))
    got = scan(spark, changed)
    kept = [label in got[i].labels.split(",") for i, (_, label) in enumerate(TEXTS)]
    # Where the word that was taken out is the one that tells two texts apart, the other label is as good.
    assert sum(kept) >= len(TEXTS) - 2
    assert all(got[i].labels for i in range(len(TEXTS)))


def plain_runs(words, template, drift, k=licenses.K):
    """Votes of the best run, by joining every two grams on near diagonals at near places, until nothing changes."""
    hits = [(p, a) for p in range(len(words) - k + 1) for a in range(len(template) - k + 1) if words[p:p + k] == template[a:a + k]]
    lines = {}
    for p, a in hits:
        lines.setdefault(p - a, set()).add(a)
    groups = [{d} for d in lines]

    def place(d):
        return d + min(lines[d]), d + max(lines[d])

    def near(one, two):
        (lo1, hi1), (lo2, hi2) = place(one), place(two)
        return abs(one - two) <= drift and max(lo1, lo2) - min(hi1, hi2) <= k + drift

    joined = True
    while joined:
        joined = False
        for i, g in enumerate(groups):
            for j in range(i + 1, len(groups)):
                if any(near(a, b) for a in g for b in groups[j]):
                    g |= groups.pop(j)
                    joined = True
                    break
            if joined:
                break
    votes = [min(len({a for d in g for a in lines[d]}), len({d + a for d in g for a in lines[d]})) for g in groups]
    return max(votes, default=0)


def test_merged_diagonals_are_those_of_a_plain_search(spark):
    rng = random.Random(4)
    template = [f"t{i}" for i in range(14)]
    texts = []
    for _ in range(60):
        words = []
        for w in template * rng.choice((1, 2)):
            if rng.random() > 0.15:
                words.append(w)
            if rng.random() < 0.15:
                words.append(rng.choice(("x", "t3", "y")))
        texts.append(" ".join([*rng.choices(("x", "t1", "t2"), k=4), *words]))
    got = scan(spark, texts, phrases={"no such phrase": "none"}, templates=((" ".join(template), "t"),), coverage=0.0)
    for i, text in enumerate(texts):
        votes = plain_runs(text.split(), template, licenses.DRIFT)
        assert abs(got[i].score - votes / (len(template) - licenses.K + 1)) < 1e-9, text
