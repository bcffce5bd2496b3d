"""Records out of text and message columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import loose_cast, parse_time
from tidemark.operators.transforms import once


@dataclass(frozen=True)
class Cell:
    """One cell of a delimited record: position, name, type, default, time format."""

    index: int
    name: str
    type: str = "string"
    default: Any = None
    fmt: str | None = None

    def column(self, items: Column | str) -> Column:
        item = F.get(items, F.lit(self.index))
        if self.type == "timestamp_ntz" and self.fmt:
            value = parse_time(item, self.fmt)
        else:
            value = loose_cast(item, self.type)
        if self.default is None:
            return value
        return F.coalesce(value, F.lit(self.default).cast(self.type))


def split_scan(df: DataFrame, col: str, sep: str, cells: Sequence[Cell], keep: Sequence[str] = ()) -> DataFrame:
    """Delimited text to typed cells. A missing cell is null, or its default."""
    split = once(df, keep, _items=F.split(F.col(col), re.escape(sep), -1))
    return split.select(*keep, *[c.column("_items").alias(c.name) for c in cells])


def json_scan(df: DataFrame, col: str, schema: T.StructType | str, root_level: bool = True) -> DataFrame:
    """Text as JSON. At root level its fields stand next to the other columns;
    otherwise they stay together in a ``message`` struct. Bad JSON gives nulls."""
    rest = [c for c in df.columns if c != col]
    parsed = once(df, rest, _json=F.from_json(F.col(col), schema))
    return parsed.select(*rest, "_json.*" if root_level else F.col("_json").alias("message"))


def line_filter(df: DataFrame, col: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Keep lines in which any ``include`` pattern is found and no ``exclude`` one is."""
    line = F.col(col)
    if include:
        df = df.filter(reduce(or_, [line.rlike(p) for p in include]))
    for pattern in exclude:
        df = df.filter(~line.rlike(pattern))
    return df


def truncate_bytes(df: DataFrame, col: str, max_bytes: int) -> DataFrame:
    """Cap a line at ``max_bytes`` bytes of UTF-8; a character cut in two is dropped."""
    data = F.col(col).cast("binary")

    def starts_char(back: int) -> Column:
        byte = F.hex(F.substring(data, max_bytes + 1 - back, 1))
        return ~byte.between("80", "BF")

    # A character has at most four bytes, so its first byte is at most three back.
    end = F.lit(max_bytes)
    for back in (3, 2, 1, 0):
        if back <= max_bytes:
            end = F.when(starts_char(back), F.lit(max_bytes - back)).otherwise(end)
    cut = F.substring(data, F.lit(1), end).cast("string")
    return df.withColumn(col, F.when(F.octet_length(data) > max_bytes, cut).otherwise(F.col(col)))


def multiline_records(df: DataFrame, col: str, head_regex: str, name: str = "record") -> DataFrame:
    """Split a text into records: a line that starts with ``head_regex`` opens one,
    lines up to the next head belong to it. Adds ``record_no``."""
    cut = F.split(F.col(col), rf"\n(?=(?:{_unanchored(head_regex)}))")
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode(cut).alias("record_no", name))


def _unanchored(head_regex: str) -> str:
    return head_regex[1:] if head_regex.startswith("^") else head_regex


def decode_messages(
    df: DataFrame,
    value_schema: T.StructType | str,
    key_type: str = "long",
    tags: Sequence[str] | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """Messages (``key``, ``value``, ``topic``[, ``tag``]) to records.

    ``key_type``: ``long`` (8 bytes, big-endian) or ``string``. The value is JSON.
    """
    if topics is not None:
        df = df.filter(F.col("topic").isin(*topics))
    if tags is not None:
        df = df.filter(F.col("tag").isin(*tags))
    keys: Mapping[str, Column] = {
        "long": F.conv(F.hex("key"), 16, -10).cast("bigint"),
        "string": F.col("key").cast("string"),
    }
    rest = [c for c in df.columns if c not in ("key", "value")]
    value = F.from_json(F.col("value").cast("string"), value_schema)
    return once(df, rest, key=keys[key_type], _value=value).select(*rest, "key", "_value.*")


def change_feed(df: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Changes of the listed ``database.table`` names only."""
    wanted = [t.split(".", 1) for t in tables]
    hits = [(F.col("database") == d) & (F.col("table") == t) for d, t in wanted]
    return df.filter(reduce(or_, hits, F.lit(False)))


def history_then_tail(history: DataFrame, live: DataFrame, seq: str) -> DataFrame:
    """Old changes first, then the live ones that come after them: no gap, no overlap."""
    seen = history.agg(F.max(seq)).scalar()
    newer = live.filter(F.coalesce(F.col(seq) > seen, seen.isNull()))
    return history.unionByName(newer, allowMissingColumns=True)

