"""Named queries over the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import settle

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(settle(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = Query(run, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_ip() -> Column:
    """An address for each event, spread over 0.0.0.0 to 255.255.255.255."""
    return dotted(F.pmod(F.col("event_id") * F.lit(2654435761), F.lit(1 << 32)))


def dotted(number: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(number, b).bitwiseAND(F.lit(255)).cast("string") for b in (24, 16, 8, 0)])


# The same address as a number, in SQL.
EVENT_IP_SQL = "((event_id * 2654435761) % 4294967296)"
DOTTED_SQL = (
    f"(({EVENT_IP_SQL} // 16777216) || '.' || (({EVENT_IP_SQL} // 65536) % 256) || '.' || "
    f"(({EVENT_IP_SQL} // 256) % 256) || '.' || ({EVENT_IP_SQL} % 256))"
)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed made of ``orders`` and ``customer``.

    Every order is inserted, every third then updated (price plus 1), every
    seventh deleted at last; every customer is inserted in another database.
    """
    o = table(spark, sf_dir, "orders")
    image = F.struct("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    raised = F.struct("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("price"))
    none = F.lit(None)
    key = F.col("o_orderkey")

    def change(op: str, seq: Column, before: Column, after: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), seq.alias("seq"), before.alias("before"), after.alias("after"))

    inserted = change("I", key * 3, none.cast("struct<o_orderkey:bigint,o_custkey:bigint,price:double>"), image)
    updated = change("U", key * 3 + 1, image, raised)
    third, seventh = key % 3 == 0, key % 7 == 0
    last = F.when(third, raised).otherwise(image)
    deleted = change("D", key * 3 + 2, last, none.cast("struct<o_orderkey:bigint,o_custkey:bigint,price:double>"))
    changes = F.array_compact(F.array(inserted, F.when(third, updated), F.when(seventh, deleted)))
    orders = o.select(F.explode(changes).alias("c")).select(
        F.lit("shop").alias("database"), F.lit("orders").alias("table"), "c.*"
    )
    c = table(spark, sf_dir, "customer")
    row = F.struct(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("price")
    )
    customers = c.select(
        F.lit("crm").alias("database"), F.lit("customer").alias("table"), F.lit("I").alias("op"),
        (F.col("c_custkey") * 3).alias("seq"),
        none.cast("struct<o_orderkey:bigint,o_custkey:bigint,price:double>").alias("before"), row.alias("after"),
    )
    return orders.unionByName(customers)


# The same feed in SQL, flat: image columns b_* and a_*.
CHANGES_SQL = """
changes AS (
  SELECT 'shop' AS database, 'orders' AS tbl, 'I' AS op, o_orderkey * 3 AS seq,
         NULL::BIGINT AS b_key, NULL::DOUBLE AS b_price, o_orderkey AS a_key, o_custkey AS a_cust, o_totalprice AS a_price
  FROM orders
  UNION ALL
  SELECT 'shop', 'orders', 'U', o_orderkey * 3 + 1, o_orderkey, o_totalprice, o_orderkey, o_custkey, o_totalprice + 1
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT 'shop', 'orders', 'D', o_orderkey * 3 + 2, o_orderkey,
         CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, NULL, NULL, NULL
  FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL
  SELECT 'crm', 'customer', 'I', c_custkey * 3, NULL, NULL, c_custkey, c_custkey, c_acctbal FROM customer
)
"""
