"""Compare a query with its SQL twin: column names, row count, values in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else round(float(value), 6) + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, run, sql, sf_dir) -> str | None:
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        return f"rows {len(ours)} != {len(theirs)}; extra {extra}; missing {missing}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{str(mine)[:600]} != {str(other)[:600]}"
    if not ours:
        return "no rows on either side"
    return None
