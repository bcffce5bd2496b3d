"""Quality classifier without hand labels: weak labellers, their accuracies, a hashed linear scorer.

1. Every document is profiled in one pass (Arrow batches, numpy over the bytes), and
   overlapping heuristics vote good, bad or nothing. Votes and features are written once
   to the shared folder; everything after reads them there. Only the number of documents
   per pattern of votes leaves the executors; there are at most 3^labellers of them,
   however many documents there are.
2. Expectation-maximisation over those counts estimates how accurate each labeller
   is on good and on bad documents, and how many are good. A pattern's posterior
   labels its documents.
3. A logistic scorer over hashed features (triples of character classes, binned
   statistics) is fitted to the posteriors of about ``FIT_ROWS`` documents. Half of them
   go by the shares of the patterns, the others fill up the rare patterns, whose
   documents are all in it; weights restore the shares, and what counts is set off
   against the rarer of good and bad, so that few bad ones among many are learnt as well.
   This bound is a parameter; counts and scores cover all.
4. Every document is scored by its features. Those below ``THRESHOLD`` are rejected.

Toxicity is another matter: these labellers look at form alone, so that a well-formed
text is kept whatever it says.

Defined results: null and empty text, and texts too short for any labeller to vote,
are scored like all others; repeated rows get equal results; a table in which no
pattern of any document is more bad than good, as an empty one, rejects nothing; other columns are carried
untouched.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import named, packed, ready, text_of, unpacked
from tidemark.session import stage

FIT_ROWS = 8192
FEATURES = 1024
THRESHOLD = 0.5
GOOD, NONE, BAD = 1, 0, -1
FEATURE = np.dtype([("place", "<u2"), ("weight", "<f4")])

# Classes of bytes: lower-case letter, upper-case letter, digit, white space, end of
# a sentence, other punctuation of prose, symbol, anything beyond ASCII (a letter).
_CLASSES = 8


def _class_table() -> np.ndarray:
    table = np.full(256, 6, dtype=np.int16)
    for i, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\v\f", b".?", b",;:'\"()-")):
        table[list(chars)] = i
    table[128:] = 7
    return table


def profile(text: bytes, table: np.ndarray) -> tuple[tuple[float, ...], np.ndarray]:
    """Statistics of a text, and its hashed features with their weights in two rows."""
    words = text.split()
    n = len(words)
    codes = table[np.frombuffer(text, dtype=np.uint8)]
    counts = np.bincount(codes, minlength=_CLASSES).tolist()
    inked = max(1, len(text) - counts[3])
    # Runs of a class count once: triples describe shapes of words, not their letters.
    if len(codes):
        codes = codes[np.concatenate(([True], codes[1:] != codes[:-1]))]
    shapes = np.bincount(codes[:-2] * 64 + codes[1:-1] * 8 + codes[2:], minlength=512) if len(codes) > 2 else np.zeros(512, dtype=np.int64)
    cube = shapes.reshape(8, 8, 8)
    stats = (
        float(n),
        counts[6] / inked,  # symbols
        counts[1] / max(1, counts[0] + counts[1]),  # upper
        sum(map(operator.eq, words, words[1:])) / max(1, n - 1),  # adjacent
        len(set(words)) / max(1, n),  # distinct
        int(cube[3, 6, 3]) / max(1, n),  # marks: a symbol for a word
        int(cube[[0, 1, 7], 6].sum()) / max(1, n),  # glued: symbols at the end of a word
        float(max(map(len, words), default=0)),  # longest
    )
    places = np.flatnonzero(shapes)
    weights = np.sqrt(shapes[places] / max(1, len(codes) - 2))
    size = min(12, int(np.log2(n + 1)))
    bins = [(i + 1) * 100_003 + int(min(value, 1.0) * 20) for i, value in enumerate(stats[1:7])]
    bins += [700_011 + 16 * int(stats[4] * 20) + size, 800_001 + size]
    keys = np.concatenate((places, np.array(bins)))
    return stats, np.vstack((_hashed(keys), np.concatenate((weights, np.full(len(bins), 0.5)))))


def _hashed(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64) % FEATURES


def votes(stats: tuple[float, ...]) -> tuple[int, ...]:
    """One vote per labeller. Short texts give no ground for some of them."""
    n, symbols, upper, adjacent, distinct, marks, glued, longest = stats
    # A text of n words of prose has at least about this share of different ones.
    least = 1.8 / np.log2(n + 2)

    def vote(grounds: bool, bad: bool, good: bool) -> int:
        return NONE if not grounds else BAD if bad else GOOD if good else NONE

    return (
        vote(n >= 3, symbols > 0.06, symbols < 0.02),
        vote(n >= 3, glued > 0.25, glued < 0.05),
        vote(n >= 3, upper > 0.5, upper < 0.25),
        vote(n >= 4, marks > 0.15, marks < 0.04),
        vote(n >= 4, symbols + marks > 0.15, symbols + marks < 0.04),
        vote(n >= 6, adjacent > 0.2, adjacent < 0.05),
        vote(n >= 12, distinct < least / 2, distinct > least),
        vote(n >= 12, adjacent > 0.1 and distinct < least, adjacent < 0.05 and distinct > least / 2),
        vote(n >= 1, longest > 200, longest < 60),
    )


def expectation_maximisation(patterns: list[tuple[int, ...]], counts: list[int], rounds: int = 100) -> np.ndarray:
    """Posterior that documents of a pattern are good (two classes, labellers independent within them).

    A labeller that does not vote says nothing. A bad document mostly has one fault, so
    few of the labellers see it: to begin with, one in three does, and one in fifty
    is wrong about a good document.
    """
    if not patterns:
        return np.zeros(0)
    cast = np.array(patterns)
    says_bad, says_good = (cast == BAD).astype(float), (cast == GOOD).astype(float)
    weight = np.array(counts, dtype=float)
    alarm, find, share = np.full(cast.shape[1], 0.02), np.full(cast.shape[1], 0.33), 0.85
    posterior = np.full(len(weight), share)
    for _ in range(rounds):
        log_good = np.log(share) + says_bad @ np.log(alarm) + says_good @ np.log1p(-alarm)
        log_bad = np.log1p(-share) + says_bad @ np.log(find) + says_good @ np.log1p(-find)
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        for_good, for_bad = weight * posterior, weight * (1 - posterior)
        # Pseudo-documents keep rates off the edges; the better a labeller, the further its two rates lie apart.
        alarm = (for_good @ says_bad + 0.02) / (for_good @ (says_bad + says_good) + 1)
        find = (for_bad @ says_bad + 0.33) / (for_bad @ (says_bad + says_good) + 1)
        share = min(max((for_good.sum() + 1) / (weight.sum() + 2), 1e-6), 1 - 1e-6)
    return posterior


@dataclass(frozen=True)
class QualityModel:
    posteriors: dict[str, float]
    weights: np.ndarray
    bias: float

    def scores(self, features: list[bytes]) -> np.ndarray:
        """Scores of documents by their features (``FEATURE`` records)."""
        together = np.frombuffer(b"".join(features), dtype=FEATURE)
        owner = np.repeat(np.arange(len(features)), [len(f) // FEATURE.itemsize for f in features])
        z = self.bias + np.bincount(owner, self.weights[together["place"]] * together["weight"], len(features))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _quotas(counts: list[int], fit_rows: int) -> list[int]:
    """How many documents of each pattern are fitted to: half by share, the others level, so that rare patterns are whole."""
    total = sum(counts)
    if total <= fit_rows:
        return counts
    by_share = [fit_rows / 2 * n / total for n in counts]
    room, left, level = fit_rows / 2, len(counts), 0.0
    for rest in sorted(n - share for n, share in zip(counts, by_share, strict=True)):
        level = room / left
        if rest > level:
            break
        room, left = room - rest, left - 1
    return [min(n, math.ceil(share + level)) for n, share in zip(counts, by_share, strict=True)]


def _fit_linear(rows: list[tuple[bytes, float, float]], rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on posteriors of weighted rows; Adam on all rows."""
    x = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for i, (features, *_) in enumerate(rows):
        each = np.frombuffer(features, dtype=FEATURE)
        np.add.at(x[i], each["place"], each["weight"])
    y = np.array([p for _, p, _ in rows], dtype=np.float32)
    weight = np.array([w for *_, w in rows])
    # By the mass of the rarer side, or its slope would be lost beside the penalty.
    rarer = max(0.5, min(weight @ y, weight @ (1 - y)))
    weight = (weight / rarer).astype(np.float32)
    theta = np.zeros(FEATURES + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        # All in single precision: a mixed product would copy the whole matrix in every round.
        p = 1 / (1 + np.exp(-np.clip(x @ theta[:-1].astype(np.float32) + np.float32(theta[-1]), -30, 30)))
        off = (p - y) * weight
        slope = np.append(x.T @ off + 1e-4 * theta[:-1], off.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _profiled(text_col: str) -> Column:
    """Struct of the pattern of votes (comma-joined) and the features (``FEATURE`` records)."""
    table = _class_table()

    @F.arrow_udf(T.StructType([T.StructField("pattern", T.StringType()), T.StructField("features", T.BinaryType())]))
    def profiles(bodies: pa.Array) -> pa.Array:
        patterns, features = [], []
        for body in bodies:
            stats, hashed = profile(body.as_py(), table)
            records = np.empty(hashed.shape[1], dtype=FEATURE)
            records["place"], records["weight"] = hashed
            patterns.append(",".join(map(str, votes(stats))))
            features.append(records.tobytes())
        return pa.StructArray.from_arrays([pa.array(patterns, pa.string()), pa.array(features, pa.binary())], names=["pattern", "features"])

    return profiles(text_of(text_col).cast("binary"))


def _fit(profiles: DataFrame, fit_rows: int) -> QualityModel:
    """Vote counts over all documents, their EM, and a scorer fitted to about ``fit_rows`` of them.

    ``profiles`` has id and profile.
    """
    counted = profiles.groupBy("profile.pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    cast = [tuple(map(int, row["pattern"].split(","))) for row in counted]
    posteriors = dict(zip((row["pattern"] for row in counted), expectation_maximisation(cast, [row["n"] for row in counted]).tolist(), strict=True))

    # Without bad documents there is nothing to tell apart: everything stays.
    if not any(p < THRESHOLD for p in posteriors.values()):
        return QualityModel(posteriors, np.zeros(FEATURES), 1.0)

    numbers = {row["pattern"]: row["n"] for row in counted}
    quotas = _quotas(list(numbers.values()), fit_rows)
    cuts = [(pattern, math.ceil(quota / n * (1 << 30))) for (pattern, n), quota in zip(numbers.items(), quotas, strict=True)]
    few = F.broadcast(profiles.sparkSession.createDataFrame(cuts, "pattern string, cut bigint"))
    drawn = profiles.select("profile.pattern", "profile.features", F.pmod(F.xxhash64("id", "profile.features", F.lit("fit")), F.lit(1 << 30)).alias("draw"))
    chosen = drawn.join(few, "pattern").where("draw < cut")
    # One repeated row may bring more than its share: whole patterns come before it.
    sample = chosen.orderBy(F.col("cut").desc(), "draw").limit(2 * fit_rows + len(cuts)).select("pattern", "features").collect()
    drawn_of = Counter(r["pattern"] for r in sample)
    rows = [(bytes(r["features"]), posteriors[r["pattern"]], numbers[r["pattern"]] / drawn_of[r["pattern"]]) for r in sample]
    return QualityModel(posteriors, *_fit_linear(rows))


def _score(model: QualityModel) -> Column:
    @F.arrow_udf(T.DoubleType())
    def score(features: pa.Array) -> pa.Array:
        return pa.array(model.scores(features.to_pylist()))

    return score(F.col("profile.features"))


def _posterior(model: QualityModel) -> Column:
    @F.arrow_udf(T.DoubleType())
    def posterior(patterns: pa.Array) -> pa.Array:
        return pa.array([model.posteriors[p] for p in patterns.to_pylist()], pa.float64())

    return posterior(F.col("profile.pattern"))


def classify_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, posterior (of the weak labels), score (of the scorer), kept."""
    ready(df.sparkSession)
    profiles = stage(df.select(named(id_col).alias("id"), _profiled(text_col).alias("profile")), "profiles")
    model = _fit(profiles, fit_rows)
    scored = profiles.select("id", _posterior(model).alias("posterior"), _score(model).alias("score"))
    return scored.select(F.col("id").alias(id_col), "posterior", "score", (F.col("score") >= threshold).alias("kept"))


def drop_low_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the scorer keeps, with all their columns."""
    ready(df.sparkSession)
    profiles = stage(df.select(packed(df).alias("doc"), named(id_col).alias("id"), _profiled(text_col).alias("profile")), "profiles")
    model = _fit(profiles.select("id", "profile"), fit_rows)
    return profiles.where(_score(model) >= threshold).select(*unpacked("doc", df.columns))
