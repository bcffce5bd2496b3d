"""Column expressions on text and loosely typed fields. All run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

NULL_MARK = "\u0000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What a text must look like to be worth a cast. A failed cast raises inside
# Spark, even in its try form, and costs some hundred times a good one.
LOOKS_LIKE = {
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"(?i)^\s*[+-]?(?:\.?\d|nan|inf)",
    "timestamp_ntz": r"^\s*\d{4}",
    "timestamp": r"^\s*\d{4}",
    "date": r"^\s*\d{4}",
}
LOOKS_LIKE |= {"float": LOOKS_LIKE["double"], "smallint": LOOKS_LIKE["int"], "tinyint": LOOKS_LIKE["int"]}
BASE64_CHARS = r"^[A-Za-z0-9+/=\s]*$"


def loose_cast(c: Column | str, to: str) -> Column:
    """Text to another type; null where it does not fit."""
    text = _col(c)
    if to == "string":
        return text.cast("string")
    value = text.try_cast(to)
    return F.when(text.rlike(LOOKS_LIKE[to]), value) if to in LOOKS_LIKE else value


def base64_text(c: Column | str, when: Column | None = None) -> Column:
    """Decode Base64 to UTF-8 text where ``when`` holds, else keep the text.

    Text that is not Base64 gives null, so that the caller can reject the record
    instead of losing the job.
    """
    text = _col(c)
    data = F.when(text.rlike(BASE64_CHARS), F.try_to_binary(text, F.lit("base64")))
    decoded = F.make_valid_utf8(data.cast("string"))
    return decoded if when is None else F.when(when, decoded).otherwise(text)


def pick(c: Column | str, sep: str, index: int) -> Column:
    """Item ``index`` of ``c`` split at the literal ``sep``; null past the end.

    Empty items at the end are kept.
    """
    return F.get(F.split(_col(c), re.escape(sep), -1), F.lit(index))


def empty_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def escape_separator(c: Column | str, sep: str = "|", replacement: str = "__") -> Column:
    """Make text safe for a one-line record: replace ``sep``, drop CR LF pairs."""
    return F.replace(F.replace(_col(c), F.lit(sep), F.lit(replacement)), F.lit("\r\n"), F.lit(""))


def strip_suffix(c: Column | str, suffix: str = "||||") -> Column:
    text = _col(c)
    cut = F.substring(text, F.lit(1), F.length(text) - F.lit(len(suffix)))
    return F.when(text.endswith(suffix), cut).otherwise(text)


def json_text(*cols: Column | str) -> Column:
    """One JSON object with the given columns; null fields are left out."""
    return F.to_json(F.struct(*cols))


def json_maps(c: Column | str, many: bool = True) -> Column:
    """JSON text to a list of maps, or (``many=False``) to one map."""
    one = "map<string,string>"
    return F.from_json(_col(c), f"array<{one}>" if many else one)


def as_string(c: Column | str) -> Column:
    return _col(c).cast("string")


def as_int(c: Column | str) -> Column:
    return loose_cast(c, "int")


def as_long(c: Column | str) -> Column:
    return loose_cast(c, "bigint")


def as_date(c: Column | str) -> Column:
    """Date and time without a zone; null where the text is none."""
    return loose_cast(c, "timestamp_ntz")


def zero_pad(c: Column | str, width: int = 6) -> Column:
    """Left-pad with zeros to ``width``; longer values stay whole."""
    text = _col(c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def stable_id(*cols: Column | str) -> Column:
    """An id that a replay of the same record gives again."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def signature(c: Column | str) -> Column:
    return F.md5(_col(c).cast("binary"))
