"""Whole jobs of the kinds that are run in practice, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import format_time
from tidemark.operators import transforms as tr
from tidemark.operators.changes import apply_changes, flatten_changes, route_changes, upsert
from tidemark.operators.lookups import decode_dim, ip_region_join
from tidemark.operators.metrics import multi_metric
from tidemark.plans.change_queries import old_orders
from tidemark.plans.metric_queries import LOG_METRICS, LOG_METRICS_SQL, RANGES_SQL, address_ranges
from tidemark.plans.registry import EVENT_IP_SQL, event_ip, order_changes, query, table
from tidemark.session import shared_folder, stage
from tidemark.sinks import records as rec
from tidemark.sinks import tables as tb
from tidemark.sources.files import multiline_scan
from tidemark.sources.records import Cell, decode_messages, split_scan
from tidemark.sources.tables import filter_scan, incremental_scan


@query("job_table_to_documents", f"""
WITH mark AS (SELECT max(event_id) // 2 AS m FROM events),
fresh AS (
  SELECT event_id AS "logId", event_type AS "operModule", strftime(ts, '%Y-%m-%d %H') AS "logOpertime", 'editor' AS author,
         CASE WHEN p_name IS NULL THEN '' ELSE '{{"p_name":"' || p_name || '","p_partkey":' || p_partkey || '}}' END AS ipinfo
  FROM events, mark LEFT JOIN ({RANGES_SQL}) ON {EVENT_IP_SQL} BETWEEN start_ip AND end_ip WHERE event_id > m)
SELECT * FROM fresh
UNION ALL SELECT event_id, 'old', '', '', '' FROM events, mark WHERE event_id <= m""")
def table_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows of a log table, enriched and renamed, put into a document table by id."""
    events = table(spark, sf_dir, "events")
    mark = events.agg(F.max("event_id")).first()[0] // 2
    rows = incremental_scan(events, "event_id", mark).rows
    rows = tr.add_fields(rows, author="editor", title="heading", subtitle="subheading")
    rows = tr.derive(rows, log_opertime=format_time("ts", "yyyy-MM-dd HH"), ip=F.concat(event_ip(), F.lit("||||")))
    rows = ip_region_join(rows, "ip", address_ranges(spark, sf_dir), ["p_name", "p_partkey"])
    rows = rows.withColumn("ipinfo", F.coalesce(F.to_json("ipinfo"), F.lit("")))
    rows = tr.rename(tr.ignore(rows, "subtitle", "title"), {"event_id": "log_id", "event_type": "oper_module"})
    docs = tr.camel_names(rows.select("log_id", "oper_module", "log_opertime", "author", "ipinfo"))
    empty = {n: F.lit("") for n in ("logOpertime", "author", "ipinfo")}
    old = events.select(F.col("event_id").alias("logId"), F.lit("old").alias("operModule"), *[c.alias(n) for n, c in empty.items()])
    # The documents that the new rows replace are in the target as well.
    return upsert(docs, old, ["logId"], "logId")


@query("job_log_files_to_metrics", LOG_METRICS_SQL)
def log_files_to_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line log files to records, records to metrics per module and user."""
    path = shared_folder(spark, "logs")
    events = table(spark, sf_dir, "events")
    stamp = F.concat(F.lit("["), format_time("ts", "yyyy-MM-dd HH:mm:ss:SSS"), F.lit("]"))
    fields = F.concat_ws(";", format_time("ts", "yyyy-MM-dd HH:mm:ss"), "event_type", "user_id")
    events.select(F.concat(stamp, F.lit("\n"), fields)).write.text(path)
    records = multiline_scan(spark, path, r"^\[\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}:\d{3}\]")
    line = records.select(F.split_part("record", F.lit("\n"), F.lit(2)).alias("line"))
    cells = [Cell(0, "ts", "timestamp_ntz", fmt="yyyy-MM-dd HH:mm:ss"), Cell(1, "event_type"), Cell(2, "user_id")]
    return multi_metric(split_scan(line, "line", ";", cells), LOG_METRICS, "ts")


@query("job_table_to_service_records", """
SELECT c_custkey || '|' || c_name || '|' || coalesce(n_name, '') || '|' || c_mktsegment AS value
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'""")
def table_to_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered rows with names for codes, as delimited records."""
    rows = filter_scan(table(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING"}, {"c_acctbal": {"gt": 0.0}})
    rows = decode_dim(rows, "c_nationkey", table(spark, sf_dir, "nation"), "n_name", "nation", key="n_nationkey")
    return rec.delimited_record(rows, ["c_custkey", "c_name", "nation", "c_mktsegment"], escape=["c_name"])


@query("job_messages_to_outputs", """
SELECT 'files' AS output, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE event_type <> 'error'
UNION ALL
SELECT 'documents', count(*), CAST(sum(event_id) AS BIGINT) FROM (SELECT max(event_id) AS event_id FROM events GROUP BY user_id)""")
def messages_to_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to rolling files, and to a document table with the last message per user."""
    path = shared_folder(spark, "message-outputs")
    events = table(spark, sf_dir, "events")
    sent = rec.encode_messages(events, "event_id", F.col("event_type"), ["event_id", "user_id", "value"], key_type="long")
    rows = decode_messages(sent, "event_id bigint, user_id bigint, value double").drop("key")
    target = rows.select("user_id", "event_id", "value").limit(0)
    tb.fan_out(rows, [
        tb.Sink("files", lambda df: tb.rolling_write(df, f"{path}/files", 100_000, "1"), filter=F.col("topic") != "error"),
        tb.Sink("documents", lambda df: tb.overwrite(upsert(df, target, ["user_id"], "event_id"), f"{path}/documents")),
    ])
    schema = "user_id bigint, event_id bigint"
    files, docs = spark.read.schema(schema).json(f"{path}/files"), spark.read.schema(schema).parquet(f"{path}/documents")

    def summary(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("output"), F.count("*").alias("n"), F.sum("event_id").alias("ids"))

    return summary("files", files).unionByName(summary("documents", docs))


@query("job_feed_to_targets", """
WITH applied AS (
  SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS price
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT -1 - c_custkey, round(c_acctbal, 2) FROM customer)
SELECT 'lake' AS target, * FROM applied
UNION ALL SELECT 'replica', o_orderkey, price FROM applied WHERE o_orderkey >= 0""")
def feed_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change feed, staged once, applied to an old copy and to an empty one."""
    routes = {"shop.orders": ["lake", "replica"]}
    routed = stage(route_changes(order_changes(spark, sf_dir), routes), "feed")
    old = old_orders(spark, sf_dir)

    def apply(name: str, target: DataFrame) -> DataFrame:
        mine = flatten_changes(routed.filter(F.col("_target") == name), ["o_orderkey"])
        out = apply_changes(target, mine, ["o_orderkey"])
        return out.select(F.lit(name).alias("target"), "o_orderkey", F.round("price", 2).alias("price"))

    return apply("lake", old).unionByName(apply("replica", old.limit(0)))
