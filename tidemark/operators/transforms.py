"""Record transforms: fields, names, filters, splits, schemas. All narrow."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import base64_text, loose_cast, wall_clock

TEMP = "_tmp_"


def as_column(value: Any) -> Column:
    """A constant as a column; a mapping becomes a struct, a list an array."""
    if isinstance(value, Column):
        return value
    if isinstance(value, Mapping):
        return F.struct(*[as_column(v).alias(k) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*[as_column(v) for v in value])
    return F.lit(value)


def add_fields(df: DataFrame, **values: Any) -> DataFrame:
    """The same value for all records; it may be nested."""
    return df.withColumns({k: as_column(v) for k, v in values.items()})


def derive(df: DataFrame, constants: Mapping[str, Any] | None = None, **exprs: Column) -> DataFrame:
    """Job-wide constants first, then record values, which win over them. Each
    expression may use the fields before it."""
    df = add_fields(df, **(constants or {}))
    return reduce(lambda d, item: d.withColumn(*item), exprs.items(), df)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_with(df: DataFrame, old: str, new: str, value: Column) -> DataFrame:
    """A new name and a new value at once; the old field goes."""
    return df.withColumn(new, value).drop(old)


def ignore(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def camel_name(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def camel_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_name(c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def name_style(df: DataFrame, camel: bool = False, lower: bool = False, upper: bool = False) -> DataFrame:
    """Field names as a job asks for them. Lower case counts only without camel case."""
    if camel:
        return camel_names(df)
    if lower:
        return lower_names(df)
    return upper_names(df) if upper else df


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop records for which the condition is true; an unknown one keeps the record."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


Rules = Sequence[tuple[str, Column]]


def reject_reason(rules: Rules) -> Column:
    """Name of the first rule whose condition is true, else null."""
    hits = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules]
    return F.coalesce(*hits)


def split_valid(df: DataFrame, rules: Rules, name: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected ones with the reason."""
    marked = df.withColumn(name, reject_reason(rules))
    return marked.filter(F.col(name).isNull()).drop(name), marked.filter(F.col(name).isNotNull())


def once(df: DataFrame, keep: Sequence[str], **exprs: Column) -> DataFrame:
    """The ``keep`` columns and the given ones, each of which is computed once per row.

    A filter on a plain computed column is pushed below it, and costly
    expressions are then run again for every use in the filter. A generator of
    one row stops that.
    """
    value = F.struct(*[c.alias(n) for n, c in exprs.items()])
    return df.select(*keep, F.inline(F.array(value)))


def csv_cells(line: Column, names: Sequence[str], sep: str = ",") -> tuple[Column, Column]:
    """Cells of a CSV line under ``names`` (empty ones are null), and the line without its quoted parts.

    The parser pads short lines, so their cells are counted by the separators
    outside of quotes: see ``cell_count``.
    """
    schema = ", ".join(f"`{n}` string" for n in names)
    cells = F.from_csv(line, schema, {"sep": sep, "quote": '"', "escape": '"'})
    return cells, F.regexp_replace(line, '"[^"]*+"', "")


def cell_count(outside: Column, sep: str = ",") -> Column:
    return F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1


# Cells of a behaviour line by position (fixed values).
BEHAVIOUR_CELLS = (
    "EVENT_KEY", "EVENT_TIME", "USER", "ATTRIBUTES", "REFERRER_DOMAIN", "COUNTRY_CODE",
    "COUNTRY_NAME", "REGION", "CITY", "BROWSER_VERSION", "OS_VERSION", "DEVICE_BRAND",
    "DEVICE_MODEL", "RESOLUTION", "IP", "USER_AGENT",
)
MIN_CELLS = 15
HEADER_USER = "user"
ENCODED_USER_EVENT = "xcxsearchEventClick"


def clean_behaviour(df: DataFrame, line_col: str) -> DataFrame:
    """Raw behaviour lines to typed cells plus ``reject_reason``.

    Rules in order: blank line, line that is no CSV, too few cells, header line,
    invalid user, user that cannot be decoded, time that cannot be read. The
    last cell is null on lines that are one cell short.
    """
    line = F.col(line_col)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    cells, outside = csv_cells(line, BEHAVIOUR_CELLS)
    rest = [c for c in df.columns if c != line_col]
    found = once(
        df, rest,
        _blank=line.isNull() | (F.trim(line) == ""), _broken=quotes % 2 == 1, _outside=outside, _cells=cells,
    )
    cell = F.col("_cells")
    typed = once(
        found, [*rest, "_blank", "_broken", "_cells"], _count=cell_count(F.col("_outside")),
        _user=base64_text(cell["USER"], cell["EVENT_KEY"] == ENCODED_USER_EVENT), _time=wall_clock(cell["EVENT_TIME"]),
    )
    reason = reject_reason([
        ("blank", F.col("_blank")),
        ("parse", F.col("_broken")),
        ("cells", F.col("_count") < MIN_CELLS),
        ("header", cell["USER"] == HEADER_USER),
        ("user", cell["USER"].contains("-")),
        ("encoding", cell["USER"].isNotNull() & F.col("_user").isNull()),
        ("time", F.col("_time").isNull()),
    ])
    values = {n: cell[n] for n in BEHAVIOUR_CELLS} | {"USER": F.col("_user"), "EVENT_TIME": F.col("_time")}
    return typed.select(*rest, *[c.alias(n) for n, c in values.items()], reason.alias("reject_reason"))


def merge_struct(df: DataFrame, struct_col: str, override: bool = False) -> DataFrame:
    """Fields of a struct next to the others. A field that both have keeps its
    value, or takes the struct's with ``override``; a null never replaces a value."""
    own = [c for c in df.columns if c != struct_col]
    inner = df.schema[struct_col].dataType.names
    merged = []
    for name in own + [n for n in inner if n not in own]:
        sides = [F.col(name)] if name in own else []
        if name in inner:
            theirs = F.col(struct_col)[name]
            sides = [theirs, *sides] if override else [*sides, theirs]
        merged.append(F.coalesce(*sides).alias(name))
    return df.select(*merged)


def merge_map(df: DataFrame, map_col: str, keys: Sequence[str], override: bool = False) -> DataFrame:
    """As ``merge_struct`` for the named keys of a map column."""
    fields = [F.col(map_col)[k].alias(k) for k in keys]
    return merge_struct(df.withColumn(map_col, F.struct(*fields)), map_col, override)


def with_temp(df: DataFrame, **exprs: Column) -> DataFrame:
    """Values that travel with the record, serve metrics, and are not written."""
    return df.withColumns({TEMP + k: v for k, v in exprs.items()})


def strip_temp(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(TEMP)])


def split_records(df: DataFrame, array: Column, name: str = "item", keep: Sequence[str] | None = None,
                  position: str | None = None) -> DataFrame:
    """One record per array item, with the ``keep`` fields (all by default)."""
    kept = df.columns if keep is None else list(keep)
    if position:
        return df.select(*kept, F.posexplode(array).alias(position, name))
    return df.select(*kept, F.explode(array).alias(name))


def project_to(df: DataFrame, mapping: Mapping[str, str | Column], types: Mapping[str, str] | None = None) -> DataFrame:
    """Target columns from source fields, as an insert template does it. A value
    that does not fit its type becomes null."""
    types = types or {}

    def target(name: str, source: str | Column) -> Column:
        value = F.col(source) if isinstance(source, str) else source
        return (_fit(df, source, types[name]) if name in types else value).alias(name)

    return df.select(*[target(n, s) for n, s in mapping.items()])


def _fit(df: DataFrame, source: str | Column, to: str) -> Column:
    """The value in another type, null where it does not fit."""
    if isinstance(source, str) and isinstance(df.schema[source].dataType, T.StringType):
        return loose_cast(source, to)
    return (F.col(source) if isinstance(source, str) else source).try_cast(to)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the fields of a stored schema: others go, missing ones are null."""
    def one(f: T.StructField) -> Column:
        to = f.dataType.simpleString()
        value = _fit(df, f.name, to) if f.name in df.columns else F.lit(None).cast(to)
        return value.alias(f.name)

    return df.select(*[one(f) for f in schema.fields])


@dataclass(frozen=True)
class Branch:
    """What happens to the records of one source table."""

    target: str
    add: Mapping[str, Any] = field(default_factory=dict)
    ignore: Sequence[str] = ()


def transform_by(df: DataFrame, branch_col: str, branches: Mapping[str, Branch], target_col: str = "_target") -> DataFrame:
    """Own target, added and ignored fields per source table, in one pass.

    Ignored fields are null in their branch; ``branch_frame`` drops them.
    """
    key = F.col(branch_col)

    def choose(per_branch: Callable[[Branch], Column | None], otherwise: Column) -> Column:
        out = otherwise
        for value, branch in branches.items():
            found = per_branch(branch)
            if found is not None:
                out = F.when(key == value, found).otherwise(out)
        return out

    added = {n for b in branches.values() for n in b.add}
    ignored = {n for b in branches.values() for n in b.ignore}
    cols = {target_col: choose(lambda b: F.lit(b.target), F.lit(None))}
    for name in sorted(added | ignored):
        start = F.col(name) if name in df.columns else F.lit(None)

        def value(b: Branch, name: str = name) -> Column | None:
            if name in b.ignore:
                return F.lit(None)
            return as_column(b.add[name]) if name in b.add else None

        cols[name] = choose(value, start)
    return df.withColumns(cols)


def branch_frame(df: DataFrame, branch_col: str, value: str, branch: Branch) -> DataFrame:
    """The records of one source table with exactly the fields of their target."""
    own = add_fields(df.filter(F.col(branch_col) == value), **branch.add)
    return own.drop(*branch.ignore)
