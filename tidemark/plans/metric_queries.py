"""Queries for lookups and metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import bucket
from tidemark.operators import lookups as lk
from tidemark.operators import metrics as mt
from tidemark.operators.accumulate import accumulate
from tidemark.operators.numbering import first_n
from tidemark.operators.transforms import with_temp
from tidemark.plans.jobs import detail_and_metrics, lines_to_behaviour, table_to_metrics
from tidemark.plans.record_queries import REJECT_SQL, behaviour_lines
from tidemark.plans.registry import EVENT_IP_SQL, event_ip, query, table
from tidemark.sinks.tables import noop_sink


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("J1_lookup_one", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey""")
def one_row(spark, sf_dir):
    """Doubled keys: the upper half of them has no customer."""
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("key"))
    out = lk.lookup_one(orders, customers, {"key": "c_custkey"}, "c", ["c_name", "c_mktsegment"])
    return out.select("o_orderkey", F.col("c.c_name").alias("c_name"), F.col("c.c_mktsegment").alias("c_mktsegment"))


@query("J1_lookup_first", """
SELECT o_orderkey, l_partkey, l_suppkey FROM orders LEFT JOIN (
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1
) ON o_orderkey = l_orderkey""")
def first_row(spark, sf_dir):
    """The dimension is not unique on the key: the first line by ship date counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    out = lk.lookup_one(orders, table(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"}, "l", ["l_partkey", "l_suppkey"], order)
    return out.select("o_orderkey", F.col("l.l_partkey").alias("l_partkey"), F.col("l.l_suppkey").alias("l_suppkey"))


@query("J2_lookup_many", """
SELECT o_orderkey, count(l_orderkey) AS lines, coalesce(round(sum(l_quantity), 2), 0) AS quantity, min(l_partkey) AS first_part
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def all_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem")
    out = lk.lookup_many(orders, lines, {"o_orderkey": "l_orderkey"}, "lines", ["l_partkey", "l_linenumber", "l_quantity"])
    total = F.aggregate("lines", F.lit(0.0), lambda acc, x: acc + x["l_quantity"])
    return out.select(
        "o_orderkey", F.size("lines").cast("bigint").alias("lines"), F.round(total, 2).alias("quantity"),
        F.get("lines", F.lit(0))["l_partkey"].alias("first_part"),
    )


@query("J2_lookup_rows", """
SELECT c_custkey, o_orderkey AS order_o_orderkey, o_totalprice AS order_o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def flat_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders")
    return lk.lookup_rows(customers, orders, {"c_custkey": "o_custkey"}, ["o_orderkey", "o_totalprice"], "order_")


@query("J3_mark_action", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey * 2 FROM orders) THEN 'U' ELSE 'I' END AS _op
FROM customer""")
def marked(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("key"))
    return lk.mark_action(table(spark, sf_dir, "customer").select("c_custkey"), orders, {"c_custkey": "key"})


@query("J4_keep_if_in", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def allowed(spark, sf_dir):
    return lk.keep_if_in(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("J4_drop_if_in", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_allowed(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return lk.keep_if_in(documents.select("doc_id", "lang"), labels, "doc_id", negate=True)


# One address range per part, of uneven size, with gaps; together they cover
# most of the address space whatever the number of parts.
RANGES_SQL = """
SELECT p_partkey, p_name, p_partkey * step + 3 AS start_ip, p_partkey * step + 3 + (step * (1 + p_size % 4)) // 5 AS end_ip
FROM part, (SELECT 4294967296 // (max(p_partkey) + 1) AS step FROM part)"""


def address_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    step = (1 << 32) // (part.agg(F.max("p_partkey")).first()[0] + 1)
    start = F.col("p_partkey") * step + 3
    width = F.floor(F.lit(step) * (1 + F.col("p_size") % 4) / 5).cast("bigint")
    return part.select("p_partkey", "p_name", start.alias("start_ip"), (start + width).alias("end_ip"))


@query("J5_ip_region_join", f"""
SELECT event_id, p_name AS region, p_partkey AS region_id FROM events
LEFT JOIN ({RANGES_SQL}) ON event_type <> 'error' AND {EVENT_IP_SQL} BETWEEN start_ip AND end_ip""")
def regions(spark, sf_dir):
    ip = F.when(F.col("event_type") == "error", "0:0:0:0:0:0:0:1||||").otherwise(F.concat(event_ip(), F.lit("||||")))
    rows = events(spark, sf_dir).select("event_id", ip.alias("ip"))
    out = lk.ip_region_join(rows, "ip", address_ranges(spark, sf_dir), ["p_name", "p_partkey"])
    return out.select("event_id", F.col("ipinfo.p_name").alias("region"), F.col("ipinfo.p_partkey").alias("region_id"))


@query("J6_decode_dim", """
SELECT c_custkey, coalesce(n_name, CAST(code AS VARCHAR), '') AS nation
FROM (SELECT c_custkey, nullif(c_nationkey, 3) + 5 AS code FROM customer) LEFT JOIN nation ON code = n_nationkey""")
def named_codes(spark, sf_dir):
    """Some codes are null, some are not in the dictionary."""
    customers = table(spark, sf_dir, "customer")
    rows = customers.select("c_custkey", (F.nullif("c_nationkey", F.lit(3)) + 5).alias("code"))
    out = lk.decode_dim(rows, "code", table(spark, sf_dir, "nation"), "n_name", "nation", key="n_nationkey")
    return out.drop("code")


@query("J7_attach_embedding", """
SELECT doc_id, CAST(len(embedding) AS INT) AS dim FROM documents LEFT JOIN embeddings ON doc_id = vec_id""")
def with_vectors(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    ok, rejected = lk.attach_embedding(docs, table(spark, sf_dir, "embeddings"), {"doc_id": "vec_id"})
    return ok.select("doc_id", F.size("embedding").alias("dim")).unionByName(
        rejected.withColumn("dim", F.lit(None).cast("int"))
    )


LABELS_SQL = """strftime(data_time, '%Y') AS year, strftime(data_time, '%Y-%m') AS month, strftime(data_time, '%G-%V') AS week,
  strftime(data_time, '%Y-%m-%d') AS day, strftime(data_time, '%Y-%m-%d %H') AS hour, strftime(data_time, '%Y-%m-%d %H:%M') AS minute"""


def bucketed(key: str, unit: str, time: str = "ts", source: str = "events") -> str:
    return f"SELECT {key} AS metric, date_trunc('{unit}', {time}) AS data_time, count(*) AS count FROM {source} GROUP BY 1, 2"


@query("A1_key_metric", "SELECT event_type AS metric, count(*) AS count FROM events GROUP BY event_type")
def per_key(spark, sf_dir):
    return mt.key_metric(events(spark, sf_dir), "event_type")


@query("A2_key_time_metric", f"SELECT *, {LABELS_SQL} FROM ({bucketed('CAST(user_id AS VARCHAR)', 'minute')})")
def per_key_time(spark, sf_dir):
    return mt.key_time_metric(events(spark, sf_dir), "user_id", "ts", "minute")


@query("A3_time_metric", f"SELECT *, {LABELS_SQL} FROM ({bucketed('event_type', 'day')})")
def per_time(spark, sf_dir):
    return mt.time_metric(events(spark, sf_dir), "event_type", "ts", "day")


@query("A4_time_key_metric", f"""
SELECT *, strftime(data_time, '%Y-%m-%d %H:%M') || '_' || metric AS time_metric_key, {LABELS_SQL}
FROM ({bucketed('event_type', 'day')})""")
def per_time_key(spark, sf_dir):
    return mt.time_key_metric(events(spark, sf_dir), "event_type", "ts", "day")


@query("A5_window_types", " UNION ALL ".join(
    f"SELECT '{w}' AS metric_type, * FROM ({bucketed('o_orderpriority', w, 'o_orderdate', 'orders')})"
    for w in ("minute", "hour", "day", "week", "month", "year")))
def every_window(spark, sf_dir):
    specs = [mt.MetricSpec(w, "o_orderpriority", w) for w in ("minute", "hour", "day", "week", "month", "year")]
    return mt.multi_metric(table(spark, sf_dir, "orders"), specs, "o_orderdate")


@query("A6_tumbling_metric", """
SELECT event_type AS metric, time_bucket(INTERVAL 100 SECOND, ts, TIMESTAMP '1970-01-01') AS data_time, count(*) AS count
FROM events GROUP BY 1, 2""")
def tumbling(spark, sf_dir):
    return mt.tumbling_metric(events(spark, sf_dir), "event_type", "ts", 100)


LOG_METRICS = [mt.MetricSpec("module", "event_type", "day"), mt.MetricSpec("user", "user_id", "day")]
LOG_METRICS_SQL = f"""
SELECT 'module' AS metric_type, * FROM ({bucketed('event_type', 'day')})
UNION ALL SELECT 'user', * FROM ({bucketed('CAST(user_id AS VARCHAR)', 'day')})"""


@query("A7_multi_metric", f"SELECT *, {LABELS_SQL} FROM ({LOG_METRICS_SQL})")
def several(spark, sf_dir):
    return table_to_metrics(events(spark, sf_dir), LOG_METRICS, "ts")


@query("A7_custom_aggregates", """
SELECT 'by_type' AS metric_type, event_type AS metric, date_trunc('month', ts) AS data_time, count(*) AS count,
       round(sum(value), 2) AS total, NULL AS last_seen
FROM events GROUP BY 2, 3
UNION ALL
SELECT 'by_user', CAST(user_id AS VARCHAR), NULL, count(*), NULL, max(ts) FROM events WHERE event_type <> 'error' GROUP BY 2""")
def own_aggregates(spark, sf_dir):
    """Metrics with their own accumulators, time and record filter in one pass."""
    specs = [
        mt.MetricSpec("by_type", "event_type", "month", aggs={"total": F.round(F.sum("value"), 2)}),
        mt.MetricSpec("by_user", "user_id", where=F.col("event_type") != "error", aggs={"last_seen": F.max("ts")}),
    ]
    return mt.multi_metric(events(spark, sf_dir), specs, "ts")


@query("A8_metric_time_columns", f"""
SELECT 'module' AS metric_type, * FROM ({bucketed('event_type', 'day')})
UNION ALL SELECT 'user', * FROM ({bucketed('CAST(user_id AS VARCHAR)', 'day', 'ts + INTERVAL 36 HOUR')})""")
def own_time(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("collecttime", F.col("ts") + F.expr("INTERVAL 36 HOURS"))
    specs = [mt.MetricSpec("module", "event_type", "day"), mt.MetricSpec("user", "user_id", "day", time="collecttime")]
    return mt.multi_metric(rows, specs, "ts")


WORD_SQL = "CAST(CAST(json_extract(props, '$.k') AS INT) AS VARCHAR)"


BEHAVIOUR_SQL = f"""
WITH rows AS (
  SELECT CAST(user_id AS VARCHAR) AS metric, date_trunc('day', ts) AS data_time, ts, event_id, event_type, {WORD_SQL} AS word
  FROM events),
texts AS (
  SELECT metric, data_time, list_reduce(list(word ORDER BY ts, event_id),
         lambda acc, w: CASE WHEN contains(acc, w) THEN acc ELSE acc || ';' || w END) AS qry_msg
  FROM rows WHERE event_type IN ('click', 'purchase') GROUP BY ALL),
days AS (
  SELECT metric, data_time, metric AS mobile, min(ts) AS create_time, count(*) FILTER (event_type = 'view') AS active_level,
         count(*) AS events
  FROM rows GROUP BY ALL)
SELECT days.metric, days.data_time, mobile, create_time, create_time AS update_time, active_level, qry_msg, events
FROM days LEFT JOIN texts ON days.metric = texts.metric AND days.data_time = texts.data_time"""
BEHAVIOUR = {
    "order_cols": ["ts", "event_id"], "time": "ts", "search_word": "word", "scene": "word", "create_time": "ts", "update_time": "ts",
    "events": ("view", "click", "purchase"),
}


def behaviour_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.from_json("props", "k int")["k"].cast("string")
    return events(spark, sf_dir).select(
        "event_id", "ts", F.col("user_id").cast("string").alias("USER"), F.col("event_type").alias("EVENT_KEY"), word.alias("word")
    )


@query("A9_user_behaviour", BEHAVIOUR_SQL)
def behaviour(spark, sf_dir):
    return mt.user_behaviour_metric(behaviour_rows(spark, sf_dir), **BEHAVIOUR)


@query("A9_custom_accumulator", """
SELECT user_id, date_trunc('day', ts) AS day, count(*) FILTER (event_type = 'view') AS level, round(max(value), 2) AS top,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
FROM events GROUP BY user_id, date_trunc('day', ts)""")
def foreign_accumulator(spark, sf_dir):
    """An accumulator written in Python, folded in the tasks and merged by key."""
    class Activity:
        def __init__(self):
            self.level, self.top, self.kinds = 0, 0.0, set()

        def add(self, record):
            self.level += record["event_type"] == "view"
            self.top = max(self.top, record["value"])
            self.kinds.add(record["event_type"])

        def merge(self, other):
            self.level += other.level
            self.top = max(self.top, other.top)
            self.kinds |= other.kinds

        def result(self):
            return {"level": self.level, "top": self.top, "kinds": ",".join(sorted(self.kinds))}

    rows = events(spark, sf_dir).withColumn("day", bucket("ts", "day"))
    schema = "level bigint, top double, kinds string"
    out = accumulate(rows, ["user_id", "day"], Activity, schema, ["event_type", "value"])
    return out.withColumn("top", F.round("top", 2))


@query("A9_behaviour_from_lines", f"""
WITH rows AS (
  SELECT 'u' || user_id AS metric, event_id, event_type,
         CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS t
  FROM events WHERE {REJECT_SQL} IS NULL)
SELECT metric, date_trunc('day', t) AS data_time, metric AS mobile, TIMESTAMP '2024-02-01 12:00:00' AS create_time,
       TIMESTAMP '2024-02-01 12:00:00' AS update_time, count(*) FILTER (event_type = 'view') AS active_level,
       CASE WHEN count(*) FILTER (event_type = 'click') > 0 THEN 'ref.example' END AS qry_msg, count(*) AS events
FROM rows GROUP BY metric, date_trunc('day', t)""")
def behaviour_of_lines(spark, sf_dir):
    """Raw lines, cleaned, to user rows. The searched word is the referrer."""
    lines = behaviour_lines(spark, sf_dir)
    return lines_to_behaviour(
        lines, "line", datetime(2024, 2, 1, 12), ["EVENT_TIME", "event_id"],
        search_word=F.col("REFERRER_DOMAIN"), scene=F.col("CITY"),
    )


@query("A10_default_key", """
SELECT CASE WHEN event_type IN ('error', 'view') THEN 'unknown module' ELSE event_type END AS metric, count(*) AS count
FROM events GROUP BY 1""")
def default_key(spark, sf_dir):
    kind = F.col("event_type")
    key = F.when(kind == "error", "").when(kind != "view", kind)
    return mt.key_metric(events(spark, sf_dir), key, "unknown module")


@query("A11_first_record", """
SELECT 'user' AS metric_type, CAST(user_id AS VARCHAR) AS metric, NULL::TIMESTAMP AS data_time, count(*) AS count,
       arg_min(event_type, event_id) AS first_type, min(event_id) AS first_id
FROM events GROUP BY user_id""")
def first_record(spark, sf_dir):
    spec = mt.MetricSpec("user", "user_id", first={"first_type": "event_type", "first_id": "event_id"}, order=["event_id"])
    return mt.multi_metric(events(spark, sf_dir), [spec])


@query("A12_event_time_default", f"""
SELECT 'named' AS metric_type, * FROM ({bucketed('event_type', 'month', "CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-03-05' ELSE ts END")})
UNION ALL SELECT 'collected', * FROM (SELECT event_type AS metric, TIMESTAMP '2024-03-01' AS data_time, count(*) AS count FROM events GROUP BY 1)""")
def time_default(spark, sf_dir):
    """The named time field, and the collection time where it is empty or not named."""
    collected = F.lit("2024-03-05").cast("timestamp_ntz")
    log_time = F.when(F.col("event_type") != "error", F.col("ts"))
    rows = events(spark, sf_dir).withColumns({"collecttime": collected, "logtime": log_time})
    named = F.coalesce("logtime", "collecttime")
    specs = [mt.MetricSpec("named", "event_type", "month", time=named), mt.MetricSpec("collected", "event_type", "month")]
    return mt.multi_metric(rows, specs, "collecttime")


@query("A13_cumulative_run", "SELECT event_type AS metric, count(*) AS count FROM events GROUP BY 1")
def cumulative(spark, sf_dir):
    """Counts of a first run, with those of a second run added."""
    rows = events(spark, sf_dir)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    first = mt.run_metric(mt.key_metric(rows.filter(F.col("ts") < cut), "event_type"), None, ["metric"], reset=False)
    second = mt.key_metric(rows.filter(F.col("ts") >= cut), "event_type")
    return mt.run_metric(second, first, ["metric"], reset=False)


@query("A13_reset_run", "SELECT event_type AS metric, count(*) AS count FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1")
def per_run(spark, sf_dir):
    rows = events(spark, sf_dir)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    first = mt.key_metric(rows.filter(F.col("ts") < cut), "event_type")
    return mt.run_metric(mt.key_metric(rows.filter(F.col("ts") >= cut), "event_type"), first, ["metric"], reset=True)


@query("A14_merge_partials", bucketed("event_type", "day"))
def partials(spark, sf_dir):
    """Rows that were persisted early, per hour, merged to one row per key and day."""
    hours = mt.key_time_metric(events(spark, sf_dir), "event_type", "ts", "hour", labels=())
    return mt.roll_up(hours, "day")


@query("A15_task_counters", """
SELECT count(*) AS total, count(*) FILTER (event_type <> 'error' AND value <= 400) AS success,
       count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type <> 'error' AND value > 400) AS ignored
FROM events""")
def counters(spark, sf_dir):
    rows, seen = mt.counted(events(spark, sf_dir), F.col("event_type") == "error", F.col("value") > 400)
    noop_sink(rows)
    return spark.createDataFrame([seen.get], "total bigint, success bigint, failed bigint, ignored bigint")


@query("A16_count_where", "SELECT count(*) FILTER (value > 100) AS count FROM events")
def conditional(spark, sf_dir):
    return mt.count_where(events(spark, sf_dir), F.col("value") > 100)


def detail_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = with_temp(events(spark, sf_dir).select("event_id", "event_type", "ts"), module=F.upper("event_type"))
    return detail_and_metrics(rows, [mt.MetricSpec("module", "_tmp_module", "day")], "ts", labels=())


@query("A17_detail", "SELECT event_id, event_type, ts FROM events")
def detail(spark, sf_dir):
    return detail_parts(spark, sf_dir)[0]


@query("A17_metrics_of_detail", f"SELECT 'module' AS metric_type, * FROM ({bucketed('upper(event_type)', 'day')})")
def detail_metrics(spark, sf_dir):
    return detail_parts(spark, sf_dir)[1]


@query("L1_limit", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 10")
def limited(spark, sf_dir):
    return first_n(events(spark, sf_dir).select("event_id", "ts"), 10, ["ts", "event_id"])


@query("L2_first_n_of_batch", """
SELECT event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 3""")
def first_of_batch(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_type", "event_id", "ts")
    return first_n(rows, 3, ["ts", "event_id"], "event_type")


