"""License scan by diagonal voting.

A document is coded as words of the templates; words that no template has get the
code zero. Every rolling k-gram of those codes is a number; grams with a zero word
cannot be in a template, all others become rows (document, place, gram). Spark joins
them to the places that the gram has in the templates. A match of a template puts
many of its grams on one diagonal (place in the document minus place in the
template), so votes are added up by (document, template, diagonal). Diagonals next
to each other whose places go on or overlap are merged, as a word more or less shifts
the rest of a text up or down, and a merged run is verified by its share of the
template's grams, each counted once.

Phrases of the contract are templates that have to match in full, on one diagonal.

The templates are a fixed list, so their side of the join is bounded.

Defined results: null text counts as empty; a text without words has zero words, no
places and score 0; repeated rows give repeated results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import named, ready, text_of
from tidemark.llm.license_texts import TEXTS

K = 3
# Diagonals that differ by at most this much belong to one match.
DRIFT = 2
# Share of a template's grams that a match needs.
COVERAGE = 0.65

# Fixed values of the contract.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")

# Texts by which licenses are known, with the library's own labels: short ones, then whole texts and notices.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under a creative commons attribution license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
    *[(b" ".join(_WORDS.findall(text.encode().lower())).decode(), label) for text, label in TEXTS],
)


def _templates(phrases: dict[str, str], templates) -> list[tuple[int, str, bool, list[str]]]:
    rows = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for text, label in templates]
    return [(i, label, base, text.split()) for i, (text, label, base) in enumerate(rows)]


def _codes(templates) -> dict[bytes, int]:
    words = sorted({w for *_, words in templates for w in words})
    return {w.encode(): i + 1 for i, w in enumerate(words)}


def _grams(codes: list[int], size: int) -> np.ndarray:
    """Rolling grams as one number each, digits in base ``size``; -1 where a word is in no template."""
    c = np.array(codes, dtype=np.int64)
    n = len(c) - K + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    gram, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(K):
        gram = gram * size + c[i:i + n]
        known &= c[i:i + n] > 0
    return np.where(known, gram, -1)


def _runs(diagonals: list[tuple[int, list[int]]], drift: int) -> list[tuple[int, int, int]]:
    """(votes, lo, hi) of the runs of a template in a text, by ``lo``; a diagonal comes with its places in the template.

    Diagonals that differ by at most ``drift`` are in one run if a place of one is near
    the places of the other, on whichever side.
    """
    marks = sorted((d + min(ats), d + max(ats), d, ats) for d, ats in diagonals)
    root = list(range(len(marks)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    # A diagonal is no longer than the template, so only some of those before can be near.
    longest = max((hi - lo for lo, hi, *_ in marks), default=0)
    first = 0
    for i, (lo, _, d, _) in enumerate(marks):
        while lo - marks[first][0] > longest + K + drift:
            first += 1
        for j in range(first, i):
            if abs(marks[j][2] - d) <= drift and lo - marks[j][1] <= K + drift:
                root[max(find(i), find(j))] = min(find(i), find(j))
    runs: dict[int, list] = {}
    for i, mark in enumerate(marks):
        runs.setdefault(find(i), []).append(mark)
    return [
        (
            min(len({at for *_, ats in run for at in ats}), len({d + at for *_, d, ats in run for at in ats})),
            min(lo for lo, *_ in run), max(hi for _, hi, *_ in run),
        )
        for run in runs.values()
    ]


def scan_licenses(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates=TEMPLATES, coverage: float = COVERAGE
) -> DataFrame:
    """One row per input row.

    id, n_words, n_base (places of phrases), first_word, last_word (their smallest and
    largest start), base_labels, labels (those of the templates too), score (the best
    share of a template that was found), spans (of all matches, in words).
    """
    if any(len(text.split()) < K for text in [*phrases, *(t for t, _ in templates)]):
        raise ValueError(f"phrases and templates have at least {K} words")
    spark = ready(df.sparkSession)
    known = _templates(phrases, templates)
    codes = _codes(known)
    size = len(codes) + 1
    source = df.select(named(id_col).alias("id"), text_of(text_col).cast("binary").alias("body"))
    kind = source.schema["id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = pa.list_(pa.struct([("place", pa.int64()), ("gram", pa.int64())]))
        code = codes.get
        for batch in parts:
            n_words, hits = [], []
            for text in batch.column("body"):
                words = _WORDS.findall(text.as_py().lower())
                n_words.append(len(words))
                grams = _grams([code(w, 0) for w in words], size)
                hits.append([{"place": p, "gram": g} for p, g in ((int(p), int(grams[p])) for p in np.flatnonzero(grams >= 0))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(hits, hit)], names=["id", "n_words", "hits"])

    coded = source.mapInArrow(batches, f"id {kind}, n_words bigint, hits array<struct<place:bigint,gram:bigint>>")
    coded = coded.withColumn("row", F.monotonically_increasing_id())
    places = [
        (t, label, base, at, int(gram), len(words) - K + 1)
        for t, label, base, words in known for at, gram in enumerate(_grams([codes[w.encode()] for w in words], size))
    ]
    positions = spark.createDataFrame(places, "template int, label string, base boolean, at bigint, gram bigint, grams bigint")

    keys = ["row", "id", "n_words"]
    hits = coded.select(*keys, F.explode_outer("hits").alias("hit")).select(*keys, "hit.place", "hit.gram")
    voted = hits.join(F.broadcast(positions), "gram", "left").withColumn("diagonal", F.col("place") - F.col("at"))
    # Votes of a diagonal; rows without any match go through as one row without a template.
    diagonals = voted.groupBy(*keys, "template", "label", "base", "grams", "diagonal").agg(F.collect_set("at").alias("ats"))
    grouped = diagonals.groupBy(*keys, "template", "label", "base", "grams").agg(F.collect_list(F.struct("diagonal", "ats")).alias("diagonals"))

    @F.arrow_udf("array<struct<votes:bigint,lo:bigint,hi:bigint>>")
    def merged(groups: pa.Array, base: pa.Array) -> pa.Array:
        out = []
        for group, phrase in zip(groups.to_pylist(), base.to_pylist(), strict=True):
            marks = [(g["diagonal"], g["ats"]) for g in group if g["diagonal"] is not None]
            # Phrases stay on one diagonal.
            found = [r for m in marks for r in _runs([m], 0)] if phrase else _runs(marks, DRIFT)
            out.append([{"votes": v, "lo": lo, "hi": hi} for v, lo, hi in found or [(0, None, None)]])
        return pa.array(out, pa.list_(pa.struct([("votes", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])))

    matches = grouped.select(*keys, "template", "label", "base", "grams", F.posexplode(merged("diagonals", "base")).alias("run", "r")).select(
        *keys, "template", "label", "base", "grams", "run", "r.votes", "r.lo", (F.col("r.hi") + K).alias("hi")
    )
    share = F.when(F.col("template").isNotNull(), F.least(F.col("votes") / F.col("grams"), F.lit(1.0))).otherwise(0.0)
    found = matches.withColumn("share", share).withColumn(
        "match", F.when(F.col("base"), F.col("votes") == F.col("grams")).otherwise(F.col("share") >= coverage)
    )
    # Overlapping matches form an island; templates that match it less well than another one give way.
    by_place = Window.partitionBy("row").orderBy(F.col("match").desc_nulls_last(), "lo", "template", "run")
    before = F.max("hi").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("island", F.when(F.col("match"), F.coalesce((F.col("lo") >= before).cast("int"), F.lit(1))))
    found = found.withColumn("island", F.sum("island").over(by_place))
    best = F.max(F.when(F.col("match"), F.col("share"))).over(Window.partitionBy("row", "island"))
    found = found.withColumn("match", F.col("match") & (F.col("base") | (F.col("share") >= best)))
    base_match = F.col("match") & F.col("base")
    span = F.struct(F.col("lo").alias("start"), F.col("hi").alias("end"), "label")

    def listed(condition) -> F.Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return found.groupBy(*keys).agg(
        F.count(F.when(base_match, 1)).alias("n_base"),
        F.min(F.when(base_match, F.col("lo"))).alias("first_word"),
        F.max(F.when(base_match, F.col("lo"))).alias("last_word"),
        listed(base_match).alias("base_labels"),
        listed(F.col("match")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("match"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("match"), span))).alias("spans"),
    ).select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
