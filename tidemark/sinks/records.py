"""Records as text and messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import empty_if_null, escape_separator, signature, stable_id
from tidemark.operators.numbering import number_rows
from tidemark.operators.transforms import as_column


def delimited_record(df: DataFrame, fields: Sequence[str | Column], sep: str = "|", escape: Sequence[str] = (),
                     name: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One line per record: fixed field order, nulls empty, the ``escape`` fields made safe for ``sep``."""
    def one(f: str | Column) -> Column:
        text = empty_if_null(f)
        return escape_separator(text, sep) if f is not None and isinstance(f, str) and f in escape else text

    return df.select(*keep, F.concat_ws(sep, *[one(f) for f in fields]).alias(name))


def json_record(df: DataFrame, name: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias(name))


def encode_messages(df: DataFrame, key: str | Column, topic: str | Column, fields: Sequence[str] | None = None,
                    key_type: str = "string") -> DataFrame:
    """``key``, JSON ``value`` and ``topic`` per record: the shape that message sinks take.

    ``key_type``: ``long`` writes the key as 8 bytes (big-endian), ``string`` as text.
    """
    raw = F.col(key) if isinstance(key, str) else key
    if key_type == "long":
        coded = F.unhex(F.lpad(F.hex(raw.cast("bigint")), 16, "0"))
    else:
        coded = raw.cast("string").cast("binary")
    to = F.lit(topic) if isinstance(topic, str) else topic
    value = F.to_json(F.struct(*(fields or df.columns))).cast("binary")
    return df.select(coded.alias("key"), value.alias("value"), to.alias("topic"))


def envelope(df: DataFrame, order_cols: Sequence[str], batch_size: int, constants: Mapping[str, Any],
             fields: Sequence[str] | None = None, data_key: str = "datas") -> DataFrame:
    """One JSON text per batch of records: constants, the records, and a signature over them.

    Batches are consecutive records in ``order_cols`` order and hold at most
    ``batch_size`` of them, so a batch always fits in a row.
    """
    fields = list(fields or df.columns)
    numbered = number_rows(df, order_cols, "_no").select(
        "_no", F.floor(F.col("_no") / batch_size).cast("bigint").alias("batch_no"), F.struct(*fields).alias("_r")
    )
    rows = F.transform(F.sort_array(F.collect_list(F.struct("_no", "_r"))), lambda p: p["_r"])
    batches = numbered.groupBy("batch_no").agg(rows.alias(data_key), F.count(F.lit(1)).alias("records"))
    parts = [as_column(v).alias(k) for k, v in constants.items()]
    signed = signature(F.to_json(data_key))
    body = F.to_json(F.struct(*parts, F.col(data_key), signed.alias("signature")))
    return batches.select("batch_no", "records", signed.alias("signature"), body.alias("body"))


def with_id(df: DataFrame, expr: Column | None = None, name: str = "_id", random: bool = False) -> DataFrame:
    """A record id: the given expression, a random UUID, or (default) a hash of all
    fields, which stays the same when the record is sent again."""
    if expr is not None:
        return df.withColumn(name, expr)
    return df.withColumn(name, F.uuid() if random else stable_id(*df.columns))


def labelled(df: DataFrame, titles: Sequence[tuple[str, str]]) -> DataFrame:
    """Ordered fields under their titles."""
    return df.select(*[F.col(f).alias(t) for f, t in titles])
