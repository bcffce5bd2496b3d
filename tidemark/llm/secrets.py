"""Secret scan: three fixed patterns, and windows of high entropy in long tokens.

Built from column expressions alone, in one pass without a shuffle. Spark has no
function for the places of matches, so a text is split at a pattern: the lengths of
the pieces and of the matches add up to the places, in code points.

The entropy of a token is that of its windows of ``WINDOW`` characters. The window
slides by one character at a time; the counts of the character that leaves and of
the one that enters change, and with them the sum of c * log2(c). Each class of
characters has its own bound; a window goes by its own class where that asks for less
than the one of its token, so that what is glued to a secret does not hide it. Tokens end
at ``=``. A part of a token, between slashes, that is named as an example is not reported,
and no window that holds an entry of the allow list.

Defined results: null text counts as empty; a text without secrets gives zeros, an
empty span list and the digest of the empty string; repeated rows give repeated
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let, named, running_sums, text_of

# Fixed values of the contract: kind, pattern, group that is measured, least length.
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # A match is as long as it can be, so the least length can stand in the pattern.
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
KINDS = (*(kind for kind, *_ in PATTERNS), "entropy")

WINDOW = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}" % WINDOW
# Bits that a window needs, by the characters of the whole token. A number has no bound;
# a token without a digit may be made of words, which often reach 3.7 bits.
CLASS_BITS = ((r"^[0-9]+$", None), (r"^[A-Za-z]+$", 3.9), (r"^[^0-9]+$", 4.0), (r"^[0-9a-fA-F]+$", 3.0), (r"^[A-Za-z0-9]+$", 3.5), (r"[0-9]", 3.7))
# The same for windows that hold a digit but not digits alone.
HEX_BITS, ALNUM_BITS = 3.0, 3.5
# Parts between slashes that are not reported, and what no reported window holds.
ALLOWED = (
    r"(?i)(^|[_-])(example|sample|dummy|placeholder|changeme|test)([_-]|$)",
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
)
ALLOWED_IN_WINDOW = r"(?i)example|sample|dummy|placeholder|changeme|test|x{4}|0{6}|1234567"
# Stands for the characters of an allowed part.
_GONE = "="

_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _places(gaps: str, hits: str, values: str, found) -> Column:
    """Spans out of pieces and matches; ``found(value, start, end)`` gives an array of those of a match."""
    def spans(x: Column, at: Column) -> Column:
        start = at + F.length(x[gaps])
        return found(x[values], start, start + F.coalesce(F.length(x[hits]), F.lit(0)))

    def listed(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda x: F.length(x[gaps]) + F.coalesce(F.length(x[hits]), F.lit(0)))
        return F.flatten(F.zip_with(pairs, running_sums(sizes), spans))

    return let(F.arrays_zip(gaps, hits, values), listed)


def _span(start: Column, kind: str, end: Column) -> Column:
    return F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))).cast(_SPAN)


_NONE = F.array


def _of_length(kind: str, least: int):
    def found(value: Column, start: Column, end: Column) -> Column:
        return F.when(F.length(value) >= least, _span(start, kind, end)).otherwise(_NONE().cast(_SPAN))

    return found


def _bits_needed(token: Column, bits=CLASS_BITS) -> Column:
    """The bound for a token; null where it has none."""
    bound = F.lit(None).cast("double")
    for pattern, value in reversed(bits):
        bound = F.when(token.rlike(pattern), F.lit(value).cast("double")).otherwise(bound)
    return bound


def _without_allowed(token: Column, allowed=ALLOWED) -> Column:
    """The token with its allowed parts blotted out; places stay."""
    def part(text: Column) -> Column:
        known = F.lit(False)
        for pattern in allowed:
            known = known | text.rlike(pattern)
        return F.when(known, F.repeat(F.lit(_GONE), F.length(text))).otherwise(text)

    return F.array_join(F.transform(F.split(token, "/"), part), "/")


def _kinds() -> Column:
    """By code: digits, hexadecimal digits, letters and digits, blotted out characters, each in a byte of its own."""
    def kind(ch: str) -> int:
        return ch.isdigit() + (ch in "0123456789abcdefABCDEF") * (1 << 8) + ch.isalnum() * (1 << 16) + (ch == _GONE) * (1 << 24)

    return F.array(*[F.lit(kind(chr(code))) for code in range(128)])


def window_range(token: Column, bits: Column, by_window: bool = False) -> Column:
    """Struct (lo, hi): from the first to the last window of at least ``bits`` bits; null fields if none has.

    ``by_window``: the class of a window may lower its bound, and allowed ones do not count.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    none = F.lit(None).cast("int")
    kinds = _kinds()
    windows = F.sequence(F.lit(0), F.greatest(F.length(token) - WINDOW, F.lit(0)))
    held = F.transform(windows, lambda i: F.substring(token, i + 1, WINDOW).rlike(ALLOWED_IN_WINDOW))
    held = F.when(token.rlike(ALLOWED_IN_WINDOW), held).otherwise(F.array().cast("array<boolean>"))
    zero = F.struct(F.lit(0.0).alias("sum"), none.alias("lo"), none.alias("hi"), F.lit(0).alias("kinds"))

    def enough(entropy: Column, seen: Column, allowed: Column) -> Column:
        if not by_window:
            return entropy >= bits
        digits = seen.bitwiseAND(0xFF)
        all_of = [F.shiftright(seen, by).bitwiseAND(0xFF) == WINDOW for by in (8, 16)]
        mixed = (digits > 0) & (digits < WINDOW)
        bound = F.least(bits, F.when(mixed & all_of[0], HEX_BITS).when(mixed & all_of[1], ALNUM_BITS))
        return (entropy >= bound) & (F.shiftright(seen, 24) == 0) & ~allowed

    def many(window: Column, code: Column) -> Column:
        return F.size(window) - F.size(F.array_remove(window, code))

    def range_of(codes: Column, held: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enter, full = F.get(codes, i), i >= WINDOW
            # Only the counts of the leaving and of the entering character change: WINDOW characters lie
            # before the entering one, and those that stay are all but the first of them.
            leave = F.get(codes, i - WINDOW)
            before = F.slice(codes, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW)))
            stay = F.slice(codes, F.greatest(i - WINDOW + 1, F.lit(0)) + 1, F.least(i, F.lit(WINDOW - 1)))
            gone, had = many(before, leave), many(stay, enter)
            lost = F.when(full, F.get(weight, gone) - F.get(weight, gone - 1)).otherwise(0.0)
            total = acc["sum"] - lost + F.get(weight, had + 1) - F.get(weight, had)
            entropy = F.lit(math.log2(WINDOW)) - total / WINDOW
            seen = acc["kinds"] + F.get(kinds, enter) - F.when(full, F.get(kinds, leave)).otherwise(0)
            allowed = F.coalesce(F.get(held, i + 1 - WINDOW), F.lit(False))
            high = (i >= WINDOW - 1) & enough(entropy, seen, allowed)
            return F.struct(
                total.alias("sum"), F.when(high & acc["lo"].isNull(), i + 1 - WINDOW).otherwise(acc["lo"]).alias("lo"),
                F.when(high, i + 1).otherwise(acc["hi"]).alias("hi"), seen.alias("kinds"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, lambda acc: F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi")))

    codes = F.transform(F.filter(F.split(token, ""), lambda ch: ch != ""), lambda ch: F.ascii(ch))
    return let(codes, lambda c: let(held, lambda h: range_of(c, h)))


def _high_entropy(value: Column, start: Column, end: Column) -> Column:
    # Windows of few different characters are below any bound; those without a digit have that of their token.
    bits = _bits_needed(value)
    least = F.pow(F.lit(2.0), F.when(value.rlike("[0-9]"), HEX_BITS).otherwise(bits))
    different = F.size(F.array_distinct(F.split(value, "")))
    left = _without_allowed(value)

    def spans(found: Column) -> Column:
        return F.when(found["lo"].isNotNull(), _span(start + found["lo"], "entropy", start + found["hi"])).otherwise(_NONE().cast(_SPAN))

    # transform over one element computes the range once.
    return F.when(
        bits.isNotNull() & (different >= least) & left.rlike("[^%s]{%d}" % (_GONE, WINDOW)),
        F.flatten(F.transform(F.array(window_range(left, bits, by_window=True)), spans)),
    ).otherwise(_NONE().cast(_SPAN))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row.

    id, n_assign, n_access, n_hex, n_entropy, base_sha256 (digest of the base spans), spans
    (``kind:start:end`` by start, then kind; end exclusive), found (the spans as an array).
    """
    out = df.select(named(id_col).alias("id"), text_of(text_col).alias("body"))
    scans = [*PATTERNS, ("entropy", TOKEN, 0, WINDOW)]
    pieces = {}
    for kind, pattern, group, _ in scans:
        pieces[f"{kind}_gaps"] = F.split("body", pattern, -1)
        pieces[f"{kind}_hits"] = F.regexp_extract_all("body", F.lit(pattern), F.lit(0))
        if group:
            pieces[f"{kind}_values"] = F.regexp_extract_all("body", F.lit(pattern), F.lit(group))
    out = out.withColumns(pieces)
    spans = {}
    for kind, _, group, least in scans:
        found = _high_entropy if kind == "entropy" else _of_length(kind, least)
        # Without a group the match itself is the value.
        values = f"{kind}_values" if group else f"{kind}_hits"
        names = (f"{kind}_gaps", f"{kind}_hits", values)
        if not group:
            out = out.withColumn(values := f"{kind}_same", F.col(f"{kind}_hits"))
            names = (f"{kind}_gaps", f"{kind}_hits", values)
        spans[kind] = F.when(F.size(f"{kind}_hits") == 0, _NONE().cast(_SPAN)).otherwise(_places(*names, found))
    out = out.select("id", *[value.alias(kind) for kind, value in spans.items()])
    base = F.concat(*[F.col(kind) for kind, *_ in PATTERNS])
    return out.select(
        F.col("id").alias(id_col),
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("entropy"))).alias("spans"),
        F.array_sort(F.concat(base, F.col("entropy"))).alias("found"),
    )
