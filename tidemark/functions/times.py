"""Column expressions on time. Results are zone-free (``timestamp_ntz``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from tidemark.functions.text import _col, loose_cast

WINDOW_TYPES = ("minute", "hour", "day", "week", "month", "year")

# Offset time text: seconds, or seconds with exactly six fraction digits.
OFFSET_TIME = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{6})?)(?:Z|[+-]\d{2}:\d{2})$"


def ntz(value: datetime | str) -> Column:
    """A zone-free literal. It folds to a constant, so a comparison with a
    ``timestamp_ntz`` column still reaches the Parquet scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def wall_clock(c: Column | str) -> Column:
    """Local wall-clock time of offset time text: the offset is dropped, not applied."""
    local = F.regexp_extract(_col(c), OFFSET_TIME, 1)
    return loose_cast(local, "timestamp_ntz")


def parse_time(c: Column | str, fmt: str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def time_or_default(c: Column | str, fmt: str, now: datetime | str) -> Column:
    """Parsed time; ``now`` (given by the caller) where the text is empty."""
    text = _col(c)
    empty = text.isNull() | (F.trim(text) == "")
    return F.when(empty, ntz(now)).otherwise(parse_time(text, fmt))


def format_time(c: Column | str, fmt: str) -> Column:
    return F.date_format(_col(c), fmt)


def from_millis(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c)).cast("timestamp_ntz")


def to_millis(c: Column | str) -> Column:
    return F.unix_millis(_col(c).cast("timestamp"))


def date_from_name(c: Column | str, prefix: str, fmt: str = "yyyyMMdd") -> Column:
    """The date that follows ``prefix`` in a (file) name; null when there is none."""
    name = _col(c)
    text = F.substring(name, F.lit(len(prefix) + 1), F.lit(len(fmt)))
    return F.when(name.startswith(prefix), parse_time(text, fmt))


def bucket(c: Column | str, window_type: str) -> Column:
    """Start of the calendar window that holds the time."""
    if window_type not in WINDOW_TYPES:
        raise ValueError(f"window_type must be one of {WINDOW_TYPES}, got {window_type!r}")
    return F.date_trunc(window_type, _col(c)).cast("timestamp_ntz")


def calendar_labels(c: Column | str) -> dict[str, Column]:
    """Text labels of a time, by name. Meant for bucket rows, after aggregation."""
    t = _col(c)
    iso_week = F.lpad(F.weekofyear(t).cast("string"), 2, "0")
    # The longer labels start with the shorter ones, so the time is formatted once.
    stamp = F.date_format(t, "yyyy-MM-dd HH:mm")
    return {
        "year": F.substring(stamp, 1, 4),
        "month": F.substring(stamp, 1, 7),
        "week": F.concat(F.extract(F.lit("YEAROFWEEK"), t).cast("string"), F.lit("-"), iso_week),
        "day": F.substring(stamp, 1, 10),
        "hour": F.substring(stamp, 1, 13),
        "minute": stamp,
    }
