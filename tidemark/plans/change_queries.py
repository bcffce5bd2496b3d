"""Queries for vectors and change data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import changes as ch
from tidemark.operators import vectors as vs
from tidemark.operators.vector_index import VectorIndex
from tidemark.plans.jobs import feed_to_table
from tidemark.plans.registry import CHANGES_SQL, order_changes, query, table
from tidemark.session import shared_folder
from tidemark.sources.records import change_feed
from tidemark.sources.tables import incremental_scan


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The query vector of the single searches: one row."""
    return embeddings(spark, sf_dir).filter("vec_id = 0").select("embedding").first()[0]


# Scores of all vectors against the first one.
SCORED_SQL = """
scored AS (
  SELECT e.vec_id, e.label, e.embedding,
         round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) AS score
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)"""


@query("V1_vector_range", f"""
WITH {SCORED_SQL} SELECT vec_id, label, round(score, 6) AS score FROM scored WHERE label <> 3 AND score >= 0.15""")
def within_radius(spark, sf_dir):
    query_vector = first_vector(spark, sf_dir)
    found = vs.vector_range(embeddings(spark, sf_dir), "embedding", query_vector, 0.15, "label <> 3", ["vec_id", "label"])
    return found.withColumn("score", F.round("score", 6))


@query("V2_vector_topk", f"""
WITH {SCORED_SQL} SELECT vec_id, label, round(score, 6) AS score FROM scored WHERE label <> 3 ORDER BY scored.score DESC, vec_id LIMIT 20""")
def most_similar(spark, sf_dir):
    query_vector = first_vector(spark, sf_dir)
    found = vs.vector_topk(embeddings(spark, sf_dir), "embedding", query_vector, 20, "vec_id", "label <> 3", ["vec_id", "label"])
    return found.withColumn("score", F.round("score", 6))


@query("V1_indexed_range", f"""
WITH {SCORED_SQL} SELECT vec_id, label, round(score, 6) AS score FROM scored WHERE label <> 3 AND score >= 0.15""")
def indexed_range(spark, sf_dir):
    """The same search over an index, which leaves out what is too far before it is read."""
    index = VectorIndex.build(embeddings(spark, sf_dir), "vec_id", "embedding", shared_folder(spark, "vectors"))
    return index.range(first_vector(spark, sf_dir), 0.15, "label <> 3", ["vec_id", "label"]).withColumn("score", F.round("score", 6))


@query("V2_indexed_topk", f"""
WITH {SCORED_SQL} SELECT vec_id, label, round(score, 6) AS score FROM scored WHERE label <> 3 ORDER BY scored.score DESC, vec_id LIMIT 20""")
def indexed_topk(spark, sf_dir):
    index = VectorIndex.build(embeddings(spark, sf_dir), "vec_id", "embedding", shared_folder(spark, "vectors"))
    return index.topk(first_vector(spark, sf_dir), 20, "vec_id", "label <> 3", ["vec_id", "label"]).withColumn("score", F.round("score", 6))


PAIRS_SQL = """
pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS id,
         round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score
  FROM embeddings q, embeddings e)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).withColumnsRenamed({"vec_id": "q_id", "embedding": "q_vec"})


@query("V3_vector_join_topk", f"""
WITH {PAIRS_SQL} SELECT query_id, id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pairs.score DESC, id) AS INT) AS rank
FROM pairs QUALIFY rank <= 5""")
def many_topk(spark, sf_dir):
    found = vs.vector_join(questions(spark, sf_dir), embeddings(spark, sf_dir), "vec_id", "embedding", "q_id", "q_vec", k=5)
    return found.withColumn("score", F.round("score", 6))


@query("V3_vector_join_radius", f"WITH {PAIRS_SQL} SELECT query_id, id, round(score, 6) AS score FROM pairs WHERE pairs.score >= 0.25")
def many_radius(spark, sf_dir):
    found = vs.vector_join(questions(spark, sf_dir), embeddings(spark, sf_dir), "vec_id", "embedding", "q_id", "q_vec", radius=0.25)
    return found.withColumn("score", F.round("score", 6))


@query("V4_vector_search_to_table", f"""
WITH {SCORED_SQL},
hits AS (SELECT vec_id, label + 100 AS label FROM scored WHERE score >= 0.05 AND vec_id > 100)
SELECT vec_id, label FROM hits
UNION ALL SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM hits)""")
def search_to_table(spark, sf_dir):
    """Hits of a search past the last copied id, put into a table by id."""
    rows = embeddings(spark, sf_dir)
    hits = vs.vector_range(rows, "embedding", first_vector(spark, sf_dir), 0.05, None, ["vec_id", "label"])
    fresh = incremental_scan(hits, "vec_id", 100).rows.withColumn("label", F.col("label") + 100)
    return ch.upsert(fresh, rows.select("vec_id", "label"), ["vec_id"], "score")


@query("V5_unpack_embedding", """
SELECT vec_id, CASE WHEN label = 1 THEN NULL ELSE CAST(len(embedding) AS INT) END AS dim,
       CASE WHEN label = 1 THEN NULL ELSE round(list_sum(embedding::DOUBLE[]), 4) END AS total, CAST(len(embedding) AS INT) AS coded_dim
FROM embeddings""")
def unpacked(spark, sf_dir):
    entry = F.struct(F.lit(0).alias("index"), F.lit("embedding").alias("object"), F.col("embedding"))
    data = F.when(F.col("label") == 1, F.array().cast("array<struct<index:int,object:string,embedding:array<float>>>")).otherwise(F.array(entry))
    rows = embeddings(spark, sf_dir).select(
        "vec_id",
        F.to_json(F.struct(F.lit("list").alias("object"), data.alias("data"))).alias("answer"),
        F.to_json(F.struct(F.lit(200).alias("code"), F.col("embedding").alias("data"))).alias("coded"),
    )
    out = vs.unpack_embedding(vs.unpack_embedding(rows, "answer"), "coded", "coded_vec", coded=True)
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    return out.select(
        "vec_id", F.size("embedding").alias("dim"), F.round(total, 4).alias("total"), F.size("coded_vec").alias("coded_dim")
    ).withColumn("dim", F.when(F.col("total").isNotNull(), F.col("dim")))


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(order_changes(spark, sf_dir), ["shop.orders"])


@query("C1_only_ops", f"WITH {CHANGES_SQL} SELECT seq, a_key AS o_orderkey FROM changes WHERE tbl = 'orders' AND op = 'I'")
def inserts(spark, sf_dir):
    return ch.only_ops(shop(spark, sf_dir), ["I"]).select("seq", F.col("after.o_orderkey").alias("o_orderkey"))


@query("C2_changed_fields", f"""
WITH {CHANGES_SQL} SELECT seq, 'price' AS changed FROM changes WHERE tbl = 'orders' AND op = 'U'""")
def differing(spark, sf_dir):
    updates = ch.only_ops(shop(spark, sf_dir), ["U"])
    found = ch.changed_fields(updates, ["o_orderkey", "o_custkey", "price"])
    return found.select("seq", F.array_join("changed", ",").alias("changed"))


@query("C3_compact_changes", f"""
WITH {CHANGES_SQL}
SELECT coalesce(a_key, b_key) AS o_orderkey, op, seq, round(coalesce(a_price, b_price), 2) AS price FROM changes WHERE tbl = 'orders'
QUALIFY row_number() OVER (PARTITION BY coalesce(a_key, b_key) ORDER BY seq DESC) = 1""")
def latest(spark, sf_dir):
    flat = ch.flatten_changes(shop(spark, sf_dir), ["o_orderkey"])
    last = ch.compact_changes(flat, ["o_orderkey"])
    return last.select("o_orderkey", "op", "seq", F.round("price", 2).alias("price"))


def old_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target before the changes: orders at another price, and customers that no change touches."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_totalprice") - 10).alias("price"))
    customers = table(spark, sf_dir, "customer").select(
        (-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("price")
    )
    return orders.unionByName(customers)


@query("C4_apply_changes", """
SELECT o_orderkey, o_custkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS price
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT -1 - c_custkey, c_custkey, round(c_acctbal, 2) FROM customer""")
def applied(spark, sf_dir):
    out = feed_to_table(order_changes(spark, sf_dir), "shop.orders", old_orders(spark, sf_dir), ["o_orderkey"])
    return out.withColumn("price", F.round("price", 2))


@query("C4_apply_changes_strict", """
SELECT t.o_orderkey * 2 AS o_orderkey, CASE WHEN c.o_orderkey % 3 = 0 THEN c.o_custkey ELSE t.o_custkey END AS o_custkey,
       round(CASE WHEN c.o_orderkey % 3 = 0 THEN c.o_totalprice + 1 ELSE t.o_totalprice - 10 END, 2) AS price
FROM orders t LEFT JOIN orders c ON c.o_orderkey = t.o_orderkey * 2
WHERE c.o_orderkey IS NULL OR c.o_orderkey % 7 <> 0""")
def applied_strict(spark, sf_dir):
    """Updates and deletes only, on a table of doubled keys: an update of a row that it lacks does nothing."""
    orders = table(spark, sf_dir, "orders")
    target = orders.select((F.col("o_orderkey") * 2).alias("o_orderkey"), "o_custkey", (F.col("o_totalprice") - 10).alias("price"))
    flat = ch.flatten_changes(ch.only_ops(shop(spark, sf_dir), ["U", "D"]), ["o_orderkey"])
    return ch.apply_changes(target, flat, ["o_orderkey"], strict=True).withColumn("price", F.round("price", 2))


@query("C5_route_changes", f"""
WITH {CHANGES_SQL}
SELECT _target, op, count(*) AS n FROM (
  SELECT unnest(CASE WHEN tbl = 'orders' THEN ['lake', 'search'] ELSE ['lake'] END) AS _target, op FROM changes) GROUP BY ALL""")
def routed(spark, sf_dir):
    routes = {"shop.orders": ["lake", "search"], "crm.customer": ["lake"]}
    return ch.route_changes(order_changes(spark, sf_dir), routes).groupBy("_target", "op").agg(F.count("*").alias("n"))


@query("C6_mark", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'D' WHEN value > 100 THEN 'U' ELSE 'I' END AS _op FROM events""")
def marked(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ch.mark(rows, {"D": F.col("event_type") == "error", "U": F.col("value") > 100}).select("event_id", "_op")


@query("K2_apply_marked", """
WITH last AS (
  SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT user_id, round(value, 2) AS value FROM last WHERE event_type <> 'error'
UNION ALL
SELECT c_custkey, round(c_acctbal, 2) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM last)""")
def marked_applied(spark, sf_dir):
    """The last event of a user sets the user's row, an error removes it."""
    rows = ch.mark(table(spark, sf_dir, "events"), {"D": F.col("event_type") == "error"})
    target = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    return ch.apply_marked(rows, target, ["user_id"], "event_id").withColumn("value", F.round("value", 2))


@query("K3_upsert", """
WITH last AS (SELECT user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT user_id, round(value, 2) AS value FROM last
UNION ALL SELECT c_custkey, round(c_acctbal, 2) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM last)""")
def upserted(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    return ch.upsert(table(spark, sf_dir, "events"), target, ["user_id"], "event_id").withColumn("value", F.round("value", 2))
