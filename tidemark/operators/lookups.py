"""Lookups: per-record queries of the classic kind, as one set-based join each.

No join here asks for a broadcast. Spark broadcasts a side by its known size, at
planning time or when the shuffle shows it, and otherwise sorts and merges,
where a hot key is split over several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions import ipv4_number, prefix_value, strip_suffix
from tidemark.operators.transforms import once

On = str | Sequence[str] | Mapping[str, str]


def _pairs(on: On) -> dict[str, str]:
    """Key columns as {left name: right name}."""
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _keyed(dim: DataFrame, on: On, value: Column, alias: str) -> DataFrame:
    return dim.groupBy(*[F.col(r).alias(f"_k_{l}") for l, r in _pairs(on).items()]).agg(value.alias(alias))


def _left_join(df: DataFrame, keyed: DataFrame, on: On, how: str = "left") -> DataFrame:
    keys = [f"_k_{l}" for l in _pairs(on)]
    condition = [df[l] == keyed[k] for l, k in zip(_pairs(on), keys)]
    return df.join(keyed, condition, how).drop(*keys)


def lookup_one(
    df: DataFrame, dim: DataFrame, on: On, alias: str, fields: Sequence[str] | None = None,
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The matching dimension row as a nested object, null without a match.

    Of several rows per key the first in ``order_cols`` counts (all fields by
    default), so a record is never multiplied.
    """
    fields = list(fields or dim.columns)
    value = F.min_by(F.struct(*fields), F.struct(*(order_cols or fields)))
    return _left_join(df, _keyed(dim, on, value, alias), on)


def lookup_as_of(
    df: DataFrame, versions: DataFrame, on: On, time: str, valid_from: str, alias: str, fields: Sequence[str], chunk_s: int = 24 * 3600,
) -> DataFrame:
    """The dimension row that was valid at the time of each record, as a nested object; null before the first.

    ``versions`` has a row per change, valid from ``valid_from`` to the next one of its key; of several
    changes at one time the last in the order of ``fields`` counts. Records and versions are merged in
    order of time, no record is compared with a version. The merge is cut by key and chunk of time, so that
    a key with most of the records is spread: which version a chunk begins with comes from a merge of
    versions with the chunks that have records, which is small. A record without a time or a key has none.
    """
    pairs = _pairs(on)
    keys = [f"_k_{name}" for name in pairs]
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    chunk = F.floor(F.col("_at") / F.lit(chunk_s * 1_000_000))
    records = df.select("*", *[F.col(name).alias(k) for name, k in zip(pairs, keys)], micros.alias("_at")).withColumn("_chunk", chunk)
    value = F.struct(*[F.col(f).alias(f) for f in fields])
    known = versions.select(
        *[F.col(r).alias(k) for r, k in zip(pairs.values(), keys)], F.unix_micros(F.col(valid_from).cast("timestamp")).alias("_at"), value.alias("_version"),
    ).dropna(subset=[*keys, "_at"])
    known = known.groupBy(*keys, "_at").agg(F.max("_version").alias("_version")).withColumn("_chunk", chunk)

    # Rows that only ask go behind a version of the same time.
    def last(*by: str) -> Column:
        return F.last("_version", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_at", F.col("_version").isNull()).rowsBetween(Window.unboundedPreceding, 0))

    none = F.lit(None).cast(known.schema["_version"].dataType)
    asked = reduce(and_, [F.col(k).isNotNull() for k in [*keys, "_at"]])
    blank = records.where(~asked).select(*df.columns, none.alias(alias))
    records = records.where(asked)
    begins = records.select(*keys, "_chunk").distinct().withColumn("_at", F.col("_chunk") * F.lit(chunk_s * 1_000_000) - F.lit(1))
    asking = begins.withColumns({"_version": none, "_asks": F.lit(True)})
    held = known.withColumn("_asks", F.lit(False)).unionByName(asking).withColumn("_held", last(*keys)).where("_asks")
    carried = held.where(F.col("_held").isNotNull()).select(*keys, "_chunk", "_at", F.col("_held").alias("_version"))

    row = F.struct(*[F.col(c) for c in df.columns])
    merged = records.select(*keys, "_chunk", "_at", none.alias("_version"), row.alias("_row")).unionByName(
        known.unionByName(carried, allowMissingColumns=True).withColumn("_row", F.lit(None).cast(row_type(df))), allowMissingColumns=True
    )
    found = merged.withColumn("_valid", last(*keys, "_chunk")).where(F.col("_row").isNotNull())
    return found.select("_row.*", F.col("_valid").alias(alias)).unionByName(blank)


def row_type(df: DataFrame) -> T.StructType:
    """The type of a whole row as one value."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


def lookup_many(df: DataFrame, dim: DataFrame, on: On, alias: str, fields: Sequence[str]) -> DataFrame:
    """All matching dimension rows as a nested list, sorted by ``fields``; empty without a match.

    A list is one cell of one record, built once per key. Where a key may have
    more rows than fit in a cell, use ``lookup_rows``.
    """
    value = F.sort_array(F.collect_list(F.struct(*fields)))
    joined = _left_join(df, _keyed(dim, on, value, alias), on)
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.array().cast(joined.schema[alias].dataType)))


def lookup_rows(df: DataFrame, dim: DataFrame, on: On, fields: Sequence[str], prefix: str) -> DataFrame:
    """As ``lookup_many``, one output row per match, so that no list is ever held."""
    keys = _pairs(on)
    right = dim.select(*[F.col(r).alias(f"_k_{l}") for l, r in keys.items()],
                       *[F.col(f).alias(prefix + f) for f in fields])
    return _left_join(df, right, on)


def mark_action(df: DataFrame, target: DataFrame, on: On, name: str = "_op") -> DataFrame:
    """``U`` where the key exists in the target, else ``I``.

    The target is cut to the keys of ``df`` first, so a small batch does not shuffle it.
    """
    found = keep_if_in(target, df, {r: l for l, r in _pairs(on).items()})
    seen = _keyed(found, on, F.lit(True), "_seen")
    joined = _left_join(df, seen, on)
    return joined.withColumn(name, F.when(F.col("_seen"), F.lit("U")).otherwise(F.lit("I"))).drop("_seen")


def keep_if_in(df: DataFrame, allowed: DataFrame, on: On, negate: bool = False) -> DataFrame:
    """Records whose key is in the list table, or (``negate``) is not."""
    pairs = _pairs(on)
    keys = allowed.select(*[F.col(r).alias(f"_k_{l}") for l, r in pairs.items()])
    condition = [df[l] == keys[f"_k_{l}"] for l in pairs]
    return df.join(keys, condition, "left_anti" if negate else "left_semi")


def decode_dim(df: DataFrame, code: str, names: DataFrame, name_col: str, alias: str, key: str | None = None) -> DataFrame:
    """Name of a code; the code itself when it has none; empty text for no code."""
    found = _keyed(names, {code: key or code}, F.min(name_col), "_name")
    text = F.coalesce(F.col("_name"), F.col(code).cast("string"), F.lit(""))
    return _left_join(df, found, {code: key or code}).withColumn(alias, text).drop("_name")


def attach_embedding(
    df: DataFrame, emb: DataFrame, on: On, vec_col: str = "embedding", order_cols: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records with their vector, and the ones that have none.

    Of several vectors per key the first in ``order_cols`` counts (the vector itself by default).
    """
    pairs = _pairs(on)
    one = _keyed(emb, on, F.min_by(vec_col, F.struct(*(order_cols or [vec_col]))), vec_col)
    return _left_join(df, one, on, "inner"), keep_if_in(df, emb, pairs, negate=True)


def range_blocks(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Cut each address range into aligned blocks (``_len``, ``_value``), at most 62.

    A block holds the addresses that share their first ``_len`` bits. An address
    then finds its range by equality, without comparing ranges.
    """
    # From the start, blocks of rising size end at each multiple of 2^k; from
    # the end, blocks of falling size start at the last such multiple.
    lo, hi = F.col(start), F.col(end) + F.lit(1)

    def power(k: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), k.cast("int"))

    def up(k: Column) -> Column:
        return F.ceil(lo / power(k)).cast("bigint") * power(k)

    def down(k: Column) -> Column:
        return F.floor(hi / power(k)).cast("bigint") * power(k)

    levels = F.sequence(F.lit(0), F.lit(32))
    leveled = ranges.withColumn("_k", F.explode(levels))
    k = F.col("_k")
    # Level k holds what lies between the multiples of 2^k and of 2^(k+1), as
    # far as it is inside the range.
    inside = up(k) <= down(k)
    next_inside = (up(k + 1) <= down(k + 1)) & (k < 32)
    left = F.when(next_inside, F.struct(up(k).alias("from"), up(k + 1).alias("to")))
    right = F.when(next_inside, F.struct(down(k + 1).alias("from"), down(k).alias("to")))
    whole = F.when(inside & ~next_inside, F.struct(up(k).alias("from"), down(k).alias("to")))
    spans = F.array_compact(F.array(left, right, whole))
    span = leveled.withColumn("_span", F.explode(spans)).filter(F.col("_span.from") < F.col("_span.to"))
    starts = F.sequence(F.col("_span.from"), F.col("_span.to") - 1, power(k))
    block = span.withColumn("_from", F.explode(starts))
    length = (F.lit(32) - k).cast("int")
    return block.select(*ranges.columns, length.alias("_len"), prefix_value("_from", length).alias("_value"))


def _narrowest_block(addresses: DataFrame, ranges: DataFrame, fields: Sequence[str], alias: str,
                     start: str, end: str) -> DataFrame:
    """Region of each address out of ranges that may lie inside each other."""
    blocks = range_blocks(ranges, start, end)
    # There are 33 block lengths at the most, so this is a handful of rows.
    lengths = sorted(r["_len"] for r in blocks.select("_len").distinct().collect())
    tries = addresses.withColumn("_len", F.explode(F.array(*[F.lit(n) for n in lengths or [0]])))
    tries = tries.withColumn("_value", prefix_value("_ip", F.col("_len")))
    narrowest = F.struct(F.col(start) - F.col(end), -F.col(start), F.struct(*fields).alias("_info"))
    return tries.join(blocks, ["_len", "_value"]).groupBy("_ip").agg(F.max(narrowest)["_info"].alias(alias))


# Addresses and ranges meet per group of 2^16 addresses.
GROUP_BITS = 16


def _last_start(addresses: DataFrame, ranges: DataFrame, fields: Sequence[str], alias: str,
                start: str, end: str) -> DataFrame:
    """Region of each address out of disjoint ranges: the range that starts last
    before it, if it reaches that far.

    A group has at most 2^16 addresses and as many starts, whatever the data, and
    disjoint ranges give at most 2^16 more rows than there are ranges.
    """
    first, last = F.shiftright(F.col(start), GROUP_BITS), F.shiftright(F.col(end), GROUP_BITS)
    pieces = ranges.filter(F.col(start) <= F.col(end)).select(
        F.explode(F.sequence(first, last)).alias("_group"), F.col(start).alias("_start"),
        F.struct(F.col(end).cast("bigint").alias("end"), F.struct(*fields).alias("info")).alias("_range"),
    )
    pieces = pieces.select("_group", F.greatest("_start", F.shiftleft("_group", GROUP_BITS)).alias("_at"), "_range")
    wanted = addresses.select(
        F.shiftright("_ip", GROUP_BITS).alias("_group"), F.col("_ip").alias("_at"),
        F.lit(None).cast(pieces.schema["_range"].dataType).alias("_range"),
    )
    in_order = Window.partitionBy("_group").orderBy("_at", F.col("_range").isNull())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = pieces.unionByName(wanted).select(
        "_at", F.col("_range").isNull().alias("_asked"),
        F.last("_range", ignorenulls=True).over(so_far).alias("_last"),
        (F.col("_range").isNotNull() & (F.max("_range.end").over(earlier) >= F.col("_at"))).alias("_overlap"),
    )
    stop = F.raise_error(F.lit("address ranges overlap: pass disjoint=False"))
    checked = F.when(F.coalesce("_overlap", F.lit(False)), stop.cast("boolean")).otherwise(F.col("_asked"))
    return seen.filter(checked & (F.col("_last.end") >= F.col("_at"))).select(
        F.col("_at").alias("_ip"), F.col("_last.info").alias(alias)
    )


def ip_region_join(
    df: DataFrame, ip_col: str, ranges: DataFrame, fields: Sequence[str], alias: str = "ipinfo",
    start: str = "start_ip", end: str = "end_ip", suffix: str = "||||", disjoint: bool = True,
) -> DataFrame:
    """Region of an address from a table of number ranges; null without a hit.

    Each distinct address is looked up once, and the records then join by
    address. Region tables are disjoint as a rule, and a violation of that stops
    the job; with ``disjoint=False`` the narrowest range around an address wins.
    """
    numbered = once(df, df.columns, _ip=ipv4_number(strip_suffix(ip_col, suffix)))
    addresses = numbered.filter(F.col("_ip").isNotNull()).select("_ip").distinct()
    find = _last_start if disjoint else _narrowest_block
    return numbered.join(find(addresses, ranges, fields, alias, start, end), "_ip", "left").drop("_ip")
