"""Change data: filter, compare, compact, apply.

A change row has ``op`` (``I``, ``U``, ``D``), ``seq`` (order of the changes),
``database``, ``table`` and the images ``before`` and ``after`` as structs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, DELETE = "I", "U", "D"


def only_ops(df: DataFrame, ops: Sequence[str], op: str = "op") -> DataFrame:
    return df.filter(F.col(op).isin(*ops))


def mark(df: DataFrame, marks: Mapping[str, Column], name: str = "_op") -> DataFrame:
    """Mark records: the first op whose condition is true, insert otherwise."""
    hits = [F.when(F.coalesce(cond, F.lit(False)), F.lit(op)) for op, cond in marks.items()]
    return df.withColumn(name, F.coalesce(*hits, F.lit(INSERT)))


def changed_fields(df: DataFrame, cols: Sequence[str], before: str = "before", after: str = "after",
                   name: str = "changed") -> DataFrame:
    """Names of the fields that differ between the two images; nulls compare as equal."""
    differ = [F.when(~F.col(before)[c].eqNullSafe(F.col(after)[c]), F.lit(c)) for c in cols]
    return df.withColumn(name, F.array_compact(F.array(*differ)))


def flatten_changes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One flat row per change: the image that counts (the one before a delete), ``op`` and ``seq``."""
    image = F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    flat = df.select("op", "seq", image.alias("_image")).select("op", "seq", "_image.*")
    missing = [k for k in keys if k not in flat.columns]
    if missing:
        raise ValueError(f"change images have no key column {missing}")
    return flat


def compact_changes(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """The latest change per key. A key with many changes is cut down to one row
    per map task before the shuffle."""
    # The order column leads, so that the largest struct is the latest row.
    rest = [seq, *[c for c in df.columns if c != seq]]
    last = F.max(F.struct(*[c for c in rest if c not in keys])).alias("_last")
    picked = df.groupBy(*keys).agg(last).select(*keys, "_last.*")
    return picked.select(*df.columns)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str = "seq", op: str = "op",
                  strict: bool = False) -> DataFrame:
    """The target after the changes, by key.

    The last change of a key decides: insert and update put the whole row, delete
    removes it, so applying a batch twice changes nothing. ``strict`` follows
    single SQL statements: an update puts a row only where one exists then,
    that is in the target or by an insert of the batch, with no delete since.

    Only the changed keys meet the target (as an anti join), so a small batch
    does not shuffle a large table. Columns of the changes that the target lacks
    are left out.
    """
    cols = target.columns
    last = compact_changes(changes, keys, seq)
    put = last.filter(F.col(op) != DELETE)
    if strict:
        def last_seq(which: str, name: str) -> Column:
            return F.max(F.when(F.col(op) == which, F.col(seq))).alias(name)

        seen = changes.groupBy(*keys).agg(last_seq(INSERT, "_ins"), last_seq(DELETE, "_del"))
        born = F.col("_ins").isNotNull() & (F.col("_del").isNull() | (F.col("_ins") > F.col("_del")))
        kept = F.col("_del").isNull() & F.coalesce(F.col("_old"), F.lit(False))
        # The target is cut to the changed keys first, so a small batch does not shuffle it.
        old = having_key(target, last, keys).select(*[F.col(k).alias(f"_k_{k}") for k in keys]).withColumn("_old", F.lit(True))
        alive = seen.join(old, _same_key(seen, old, keys), "left").filter(born | kept)
        put = having_key(put, alive, keys)
    types = dict(target.dtypes)
    rows = put.select(*[F.col(c).cast(types[c]).alias(c) for c in cols])
    return having_key(target, last.select(*keys), keys, "left_anti").unionByName(rows)


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys; a null is a key like any other, or a replay would add its row again."""
    return reduce(and_, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def having_key(df: DataFrame, found: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    wanted = found.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return df.join(wanted, _same_key(df, wanted, keys), how)


def apply_marked(df: DataFrame, target: DataFrame, keys: Sequence[str], seq: str, name: str = "_op") -> DataFrame:
    """Put marked records (see ``mark``) into a target."""
    return apply_changes(target, df, keys, seq, name)


def upsert(df: DataFrame, target: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Last record per key wins over earlier ones and over the target."""
    return apply_changes(target, df.withColumn("_op", F.lit(UPDATE)), keys, seq, "_op")


def route_changes(df: DataFrame, routes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``_target``: the targets of the change's ``database.table``, one row per target.

    Changes of tables without a route go nowhere.
    """
    name = F.concat_ws(".", "database", "table")
    found = F.lit(None).cast("array<string>")
    for table, targets in routes.items():
        found = F.when(name == table, F.array(*[F.lit(t) for t in targets])).otherwise(found)
    return df.withColumn("_target", F.explode(found))
