"""Scans of tables: SQL extracts, incremental scans, filtered, sliced and paged scans."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.functions import ntz
from tidemark.operators.numbering import number_rows


MARKER = re.compile(r"#\[\s*(\w+)[^\]]*\]")
FRAGMENT = re.compile(r"@\{\s*(\w+)\s*\}")
REMARK = re.compile(r"##[^\n]*")


def sql_scan(
    spark: SparkSession,
    query: str,
    url: str | None = None,
    driver: str | None = None,
    fetch_size: int = 5000,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """Rows of ``query`` on a JDBC source, or without ``url`` on the session's own tables and views.

    ``split`` = (column, lower, upper, parts) reads a JDBC result as parallel
    ranges; without it one task reads everything, so give it for large tables.
    """
    if url is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(
        **sql_scan_options(url, query, driver, fetch_size, split, **options)
    ).load()


def sql_scan_options(
    url: str,
    query: str,
    driver: str | None = None,
    fetch_size: int = 5000,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> dict[str, str]:
    found = {"url": url, "fetchsize": str(fetch_size), **options}
    if driver:
        found["driver"] = driver
    if split is None:
        return {**found, "query": query}
    column, lower, upper, parts = split
    # Spark takes a partitioned read only from "dbtable".
    return {
        **found,
        "dbtable": f"({query}) extract_rows",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def load_catalog(path: str) -> dict[str, str]:
    """Named queries of a properties XML file (``<property name="…">text</property>``)."""
    return {p.get("name"): (p.text or "").strip() for p in ET.parse(path).getroot().iter("property")}


def resolve_query(catalog: Mapping[str, str], name: str, _seen: tuple[str, ...] = ()) -> str:
    """The text of a named query as Spark SQL: fragments ``@{name}`` put in, remarks
    dropped, and each ``#[var]`` turned into the parameter marker ``:var``."""
    if name in _seen:
        raise ValueError(f"fragment {name!r} includes itself")
    text = FRAGMENT.sub(lambda m: resolve_query(catalog, m[1], (*_seen, name)), catalog[name])
    return MARKER.sub(r":\1", REMARK.sub("", text))


def named_query(
    spark: SparkSession,
    catalog: Mapping[str, str],
    name: str,
    tables: Mapping[str, DataFrame] | None = None,
    **args: Any,
) -> DataFrame:
    """Run a named query with bound parameters over the given tables."""
    for view, df in (tables or {}).items():
        df.createOrReplaceTempView(view)
    text = resolve_query(catalog, name)
    used = set(re.findall(r":(\w+)", text))
    return spark.sql(text, args={k: v for k, v in args.items() if k in used})


@dataclass
class Increment:
    """Rows newer than the last mark. ``mark()`` is known once ``rows`` was written:
    it comes out of that same pass, so the source is read only once."""

    rows: DataFrame
    last: Any
    _seen: Observation

    def mark(self) -> Any:
        found = self._seen.get["mark"]
        return self.last if found is None else found


def _increment(df: DataFrame, mark: str, last: Any, *bounds: Column | None) -> Increment:
    rows = reduce(DataFrame.filter, [b for b in bounds if b is not None], df)
    seen = Observation()
    return Increment(rows.observe(seen, F.max(mark).alias("mark")), last, seen)


def incremental_scan(df: DataFrame, col: str, last: int | float | None) -> Increment:
    """Rows with ``col > last``; everything when there is no last value."""
    return _increment(df, col, last, None if last is None else F.col(col) > F.lit(last))


def incremental_scan_ts(
    df: DataFrame,
    col: str,
    last: datetime | None,
    now: datetime | None = None,
    end_offset_s: int = 0,
    zoned: bool = False,
) -> Increment:
    """Rows with ``last < col <= now - end_offset_s``.

    The end offset leaves the newest seconds to the next run, so that rows which
    arrive a little late are not jumped over. ``zoned`` = the column has a zone
    (``timestamp``); otherwise it is a local date and time (``timestamp_ntz``).
    """
    literal = F.lit if zoned else ntz
    low = None if last is None else F.col(col) > literal(last)
    high = None if now is None else F.col(col) <= literal(now - timedelta(seconds=end_offset_s))
    return _increment(df, col, last, low, high)


def incremental_scan_millis(
    df: DataFrame, col: str, last: int | None, now_ms: int | None = None, end_offset_s: int = 0
) -> Increment:
    """As ``incremental_scan_ts`` for a column of epoch milliseconds."""
    low = None if last is None else F.col(col) > F.lit(last)
    high = None if now_ms is None else F.col(col) <= F.lit(now_ms - 1000 * end_offset_s)
    return _increment(df, col, last, low, high)


def filter_scan(
    df: DataFrame,
    terms: Mapping[str, Any] | None = None,
    ranges: Mapping[str, Mapping[str, Any]] | None = None,
) -> DataFrame:
    """Conjunction of equality terms and range bounds (``gt``, ``gte``, ``lt``, ``lte``)."""
    compare: dict[str, Callable[[Column, Any], Column]] = {
        "gt": lambda c, v: c > v,
        "gte": lambda c, v: c >= v,
        "lt": lambda c, v: c < v,
        "lte": lambda c, v: c <= v,
    }
    for col, value in (terms or {}).items():
        df = df.filter(F.col(col) == value)
    for col, bounds in (ranges or {}).items():
        for how, value in bounds.items():
            df = df.filter(compare[how](F.col(col), value))
    return df


def with_slice(df: DataFrame, id_col: str, slice_max: int, name: str = "slice_id") -> DataFrame:
    """The number of the slice that each row belongs to."""
    return df.withColumn(name, F.pmod(F.xxhash64(id_col), F.lit(slice_max)).cast("int"))


def slice_scan(df: DataFrame, id_col: str, slice_id: int, slice_max: int) -> DataFrame:
    """Slice ``slice_id`` of ``slice_max`` disjoint slices; their union is the table."""
    return with_slice(df, id_col, slice_max, "_slice").filter(F.col("_slice") == slice_id).drop("_slice")


def page(df: DataFrame, order_cols: Sequence[str], offset: int, size: int) -> DataFrame:
    """Rows ``offset`` .. ``offset + size - 1`` in the given order (which must identify a row), sorted by it.

    A page of any depth is cut out of the distributed row numbers; ``page_after`` goes
    through a table page by page without numbering it.
    """
    return number_rows(df, order_cols, "_row_no", only=(offset, offset + size - 1)).drop("_row_no").orderBy(*order_cols)


def page_after(df: DataFrame, order_cols: Sequence[str], after: Sequence[Any] | None, size: int) -> DataFrame:
    """The page that follows the key ``after``: any depth costs one filtered top-k."""
    if after is not None:
        types = dict(df.dtypes)
        key = F.struct(*order_cols)
        last = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order_cols, after)])
        df = df.filter(key > last)
    return df.orderBy(*order_cols).limit(size)


def expr_scan(df: DataFrame, expr: str | None, fields: Sequence[str]) -> DataFrame:
    """Rows that match a SQL expression, reduced to the output fields."""
    return (df.filter(F.expr(expr)) if expr else df).select(*fields)


def slices_union(df: DataFrame, id_col: str, slice_max: int) -> DataFrame:
    """All slices out of one scan, each row with the others of its slice; equals the table."""
    return with_slice(df, id_col, slice_max, "_slice").repartition(slice_max, "_slice").drop("_slice")
