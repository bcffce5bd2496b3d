"""Queries for record transforms and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import functions as fn
from tidemark.operators import transforms as tr
from tidemark.operators.metrics import key_metric
from tidemark.operators.numbering import number_rows
from tidemark.plans.registry import DOTTED_SQL, EVENT_IP_SQL, event_ip, query, table

NOW = datetime(2024, 2, 1, 12)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("P1_add_fields", """
SELECT event_id, 'duo' AS author, 'Xiaokang' AS doc_subtitle, 5 AS doc_level FROM events""")
def constants(spark, sf_dir):
    out = tr.add_fields(events(spark, sf_dir), author="duo", doc={"subtitle": "Xiaokang", "level": 5})
    return out.select("event_id", "author", F.col("doc.subtitle").alias("doc_subtitle"), F.col("doc.level").alias("doc_level"))


@query("P2_derive", """
SELECT event_id, event_type || '-' || user_id AS author, value * 2 AS twice FROM events""")
def derived(spark, sf_dir):
    out = tr.derive(
        events(spark, sf_dir), {"author": "duo"},
        author=F.concat_ws("-", "event_type", "user_id"), twice=F.col("value") * 2,
    )
    return out.select("event_id", "author", "twice")


@query("P3_rename", "SELECT event_id AS log_id, event_type AS oper_module, value FROM events")
def renamed(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    return tr.rename(rows, {"event_id": "log_id", "event_type": "oper_module"})


@query("P4_rename_with", "SELECT event_id, event_type || ' append new Value' AS new_title FROM events")
def renamed_with(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type")
    return tr.rename_with(rows, "event_type", "new_title", F.concat("event_type", F.lit(" append new Value")))


@query("P5_ignore", "SELECT event_id, ts FROM events")
def ignored(spark, sf_dir):
    return tr.ignore(events(spark, sf_dir), "user_id", "event_type", "value", "props")


@query("P6_camel_names", 'SELECT event_id AS "eventId", user_id AS "userId", event_type AS "eventType" FROM events')
def camel(spark, sf_dir):
    return tr.camel_names(events(spark, sf_dir).select("event_id", "user_id", "event_type"))


@query("P7_upper_names", 'SELECT event_id AS "EVENT_ID", user_id AS "USER_ID" FROM events')
def upper(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id")
    return tr.name_style(tr.lower_names(rows), upper=True)


@query("P8_drop_where", "SELECT event_id, value FROM events WHERE NOT coalesce(nullif(user_id, 7) > 100, false)")
def dropped(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "value", F.nullif("user_id", F.lit(7)).alias("u"))
    return tr.drop_where(rows, F.col("u") > 100).drop("u")


def behaviour_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw behaviour lines, with every kind of bad line among them."""
    key = F.col("event_id")

    def every(n: int, rest: int) -> Column:
        return key % n == rest

    event_key = F.when(F.col("event_type") == "view", "$page").when(
        F.col("event_type") == "click", tr.ENCODED_USER_EVENT
    ).otherwise(F.col("event_type"))
    name = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    user = (
        F.when(every(101, 3), F.lit("user"))
        .when(every(50, 7), F.concat(F.lit("u-"), F.col("user_id").cast("string")))
        .when(F.col("event_type") == "click", F.base64(F.encode(name, "UTF-8")))
        .otherwise(name)
    )
    time = F.when(every(2, 0), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    cells = [event_key, F.concat(time, F.lit("+08:00")), user, F.lit('"{""a"": 1, ""b"": 2}"'), F.lit("ref.example")]
    cells += [F.lit(f"c{i}") for i in range(5, 14)]
    cells += [event_ip()]
    line = F.concat_ws(",", *cells)
    text = (
        F.when(every(89, 1), F.lit("  "))
        .when(every(83, 2), F.concat(line, F.lit(',"open')))
        .when(every(97, 5), F.lit("a,b,c"))
        .when(every(11, 0), line)
        .otherwise(F.concat(line, F.lit(',"agent, with comma"')))
    )
    return events(spark, sf_dir).select("event_id", text.alias("line"))


REJECT_SQL = """
CASE WHEN event_id % 89 = 1 THEN 'blank' WHEN event_id % 83 = 2 THEN 'parse' WHEN event_id % 97 = 5 THEN 'cells'
     WHEN event_id % 101 = 3 THEN 'header' WHEN event_id % 50 = 7 THEN 'user' END"""


@query("P9_clean_behaviour", f"""
SELECT event_id, 'u' || user_id AS "USER",
       CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS "EVENT_TIME",
       '{{"a": 1, "b": 2}}' AS "ATTRIBUTES",
       CASE WHEN event_id % 11 <> 0 THEN 'agent, with comma' END AS "USER_AGENT"
FROM events WHERE {REJECT_SQL} IS NULL""")
def cleaned(spark, sf_dir):
    rows = tr.clean_behaviour(behaviour_lines(spark, sf_dir), "line").filter(F.col("reject_reason").isNull())
    return rows.select("event_id", "USER", "EVENT_TIME", "ATTRIBUTES", "USER_AGENT")


@query("P10_reject_routing", f"""
SELECT {REJECT_SQL} AS reject_reason, count(*) AS n FROM events GROUP BY 1""")
def rejects(spark, sf_dir):
    rows = tr.clean_behaviour(behaviour_lines(spark, sf_dir), "line")
    return rows.groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("P10_split_valid", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'error event' WHEN value > 400 THEN 'too large' ELSE 'ok' END AS outcome
FROM events""")
def valid_and_not(spark, sf_dir):
    rules = [("error event", F.col("event_type") == "error"), ("too large", F.col("value") > 400)]
    ok, rejected = tr.split_valid(events(spark, sf_dir).select("event_id", "event_type", "value"), rules)
    good = ok.select("event_id", F.lit("ok").alias("outcome"))
    return good.unionByName(rejected.select("event_id", F.col("reject_reason").alias("outcome")))


@query("P11_merge_struct", """
SELECT event_id, event_type, coalesce(nullif(event_type, 'error'), 'fixed') AS kind,
       CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def merged(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id", "event_type", F.nullif("event_type", F.lit("error")).alias("kind"),
        F.struct(F.lit("fixed").alias("kind"), F.from_json("props", "k int")["k"].alias("k")).alias("more"),
    )
    return tr.merge_struct(rows, "more")


@query("P12_temp_fields", """
SELECT event_type || '-' || strftime(ts, '%Y-%m') AS metric, count(*) AS count, 2 AS written_columns FROM events GROUP BY 1""")
def temp_fields(spark, sf_dir):
    """A temp field feeds a metric and is not among the written columns."""
    group = F.concat_ws("-", "event_type", F.date_format("ts", "yyyy-MM"))
    rows = tr.with_temp(events(spark, sf_dir).select("event_id", "event_type", "ts"), group=group).drop("ts")
    written = len(tr.strip_temp(rows).columns)
    return key_metric(rows, "_tmp_group").withColumn("written_columns", F.lit(written))


@query("P13_split_records", """
SELECT event_id, i || '-' || event_type AS message FROM events, (SELECT unnest(range(10)) AS i)""")
def split_rows(spark, sf_dir):
    copies = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(i.cast("string"), F.lit("-"), F.col("event_type")))
    return tr.split_records(events(spark, sf_dir), copies, "message", keep=["event_id"])


@query("P14_project_to", """
SELECT event_type AS name, 'duo' AS author, CAST(user_id AS VARCHAR) AS oper, ts AS optime, value AS score, event_id AS id
FROM events""")
def projected(spark, sf_dir):
    mapping = {"id": "event_id", "name": "event_type", "author": F.lit("duo"), "oper": "user_id", "optime": "ts", "score": "value"}
    return tr.project_to(events(spark, sf_dir), mapping, {"oper": "string", "optime": "timestamp_ntz"})


@query("P15_conform", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS remark FROM events""")
def conformed(spark, sf_dir):
    schema = T.StructType().add("event_id", "long").add("user_id", "string").add("remark", "string")
    return tr.conform(events(spark, sf_dir), schema)


@query("P16_transform_by", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' END AS _target,
       CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'v' END AS mark,
       CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value FROM events""")
def per_table(spark, sf_dir):
    branches = {
        "click": tr.Branch("clicks", {"mark": "c"}),
        "view": tr.Branch("views", {"mark": "v"}, ["value"]),
    }
    return tr.transform_by(events(spark, sf_dir).select("event_id", "event_type", "value"), "event_type", branches).drop("event_type")


@query("P17_row_number", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_no FROM events")
def row_numbers(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "ts")
    return number_rows(rows, ["ts", "event_id"], "row_no").select("event_id", "row_no")


@query("F1_base64_text", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS plain,
       CASE WHEN event_type = 'error' THEN '%%%' WHEN event_type = 'view' THEN 'view' ELSE base64(encode(event_type)) END AS kept
FROM events""")
def decoded(spark, sf_dir):
    coded = F.when(F.col("event_type") == "error", "%%%").otherwise(F.base64(F.encode("event_type", "UTF-8")))
    rows = events(spark, sf_dir).select("event_id", "event_type", coded.alias("coded"))
    return rows.select(
        "event_id", fn.base64_text("coded").alias("plain"), fn.base64_text("coded", F.col("event_type") == "view").alias("kept")
    )


@query("F2_wall_clock", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS local
FROM events""")
def wall_clocks(spark, sf_dir):
    long = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("-07:00"))
    short = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))
    text = F.when(F.col("event_type") == "error", "no time").when(F.col("event_id") % 2 == 0, long).otherwise(short)
    return events(spark, sf_dir).select("event_id", fn.wall_clock(text).alias("local"))


@query("F3_time_or_default", """
SELECT event_id, CASE event_type WHEN 'error' THEN TIMESTAMP '2024-02-01 12:00:00' WHEN 'view' THEN NULL
       ELSE date_trunc('minute', ts) END AS t FROM events""")
def default_times(spark, sf_dir):
    kind = F.col("event_type")
    text = F.when(kind == "error", " ").when(kind == "view", "soon").otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm"))
    return events(spark, sf_dir).select("event_id", fn.time_or_default(text, "yyyy/MM/dd HH:mm", NOW).alias("t"))


@query("F4_parse_time", "SELECT event_id, date_trunc('second', ts) AS t FROM events")
def parsed_times(spark, sf_dir):
    text = F.date_format("ts", "dd.MM.yyyy HH:mm:ss")
    return events(spark, sf_dir).select("event_id", fn.parse_time(text, "dd.MM.yyyy HH:mm:ss").alias("t"))


@query("F5_format_time", """
SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS stamp, strftime(ts, '%Y-%m-%d %H') AS hour
FROM events""")
def formatted(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", fn.format_time("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("stamp"), fn.format_time("ts", "yyyy-MM-dd HH").alias("hour")
    )


@query("F6_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp(epoch_us(ts) // 1000 * 1000) AS back FROM events""")
def millis(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", fn.to_millis("ts").alias("ms"))
    return rows.withColumn("back", fn.from_millis("ms"))


@query("F7_calendar_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS month,
       strftime(o_orderdate, '%G-%V') AS week, strftime(o_orderdate, '%Y-%m-%d') AS day,
       strftime(o_orderdate, '%Y-%m-%d %H') AS hour, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS minute FROM orders""")
def labels(spark, sf_dir):
    found = fn.calendar_labels("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in found.items()])


@query("F8_pick", """
SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[3] AS third_word FROM documents""")
def picked(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fn.pick("text", " ", 0).alias("first_word"), fn.pick("text", " ", 2).alias("third_word"))


@query("F9_empty_if_null", "SELECT event_id, coalesce(nullif(event_type, 'error'), '') AS kind FROM events")
def no_nulls(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", fn.empty_if_null(F.nullif("event_type", F.lit("error"))).alias("kind"))


@query("F10_escape_separator", """
SELECT doc_id, md5(replace(replace(replace(text, chr(10), chr(13) || chr(10)), '|', '__'), chr(13) || chr(10), '')) AS safe
FROM documents""")
def escaped(spark, sf_dir):
    text = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    return table(spark, sf_dir, "documents").select("doc_id", fn.signature(fn.escape_separator(text)).alias("safe"))


@query("F11_strip_suffix", f"SELECT event_id, {DOTTED_SQL} AS ip FROM events")
def stripped(spark, sf_dir):
    ip = F.when(F.col("event_type") == "view", event_ip()).otherwise(F.concat(event_ip(), F.lit("||||")))
    return events(spark, sf_dir).select("event_id", fn.strip_suffix(ip).alias("ip"))


@query("F12_text_tests", """
SELECT c_custkey, starts_with(c_name, 'Customer') AS starts, ends_with(c_name, '7') AS ends, contains(c_name, '00') AS has,
       lower(c_mktsegment) AS low, trim(' ' || c_mktsegment || ' ') AS trimmed, CAST(instr(c_name, '#') AS INT) AS at FROM customer""")
def text_tests(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", name.startswith("Customer").alias("starts"), name.endswith("7").alias("ends"),
        name.contains("00").alias("has"), F.lower("c_mktsegment").alias("low"),
        F.trim(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("trimmed"), F.instr(name, "#").alias("at"),
    )


@query("F13_json", """
SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS record,
       CAST(json_extract(props, '$.k') AS VARCHAR) AS k, 1 AS maps FROM events""")
def json_both_ways(spark, sf_dir):
    rows = events(spark, sf_dir)
    many = fn.json_maps(F.concat(F.lit("["), "props", F.lit("]")))
    return rows.select(
        "event_id", fn.json_text("event_id", "event_type").alias("record"),
        fn.json_maps("props", many=False)["k"].alias("k"), F.size(many).alias("maps"),
    )


@query("F14_typed_getters", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INT) END AS whole,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_id * 1000000007 END AS large,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS time, CAST(event_id AS VARCHAR) AS text FROM events""")
def getters(spark, sf_dir):
    def loose(c: Column) -> Column:
        return F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(c.cast("string"))

    return events(spark, sf_dir).select(
        "event_id", fn.as_int(loose(F.col("user_id"))).alias("whole"),
        fn.as_long(loose(F.col("event_id") * 1000000007)).alias("large"),
        fn.as_date(loose(F.col("ts"))).alias("time"), fn.as_string("event_id").alias("text"),
    )


@query("F15_stable_id", "SELECT event_id, sha256(event_id || chr(1) || event_type) AS id FROM events")
def ids(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", fn.stable_id("event_id", "event_type").alias("id"))


@query("F16_zero_pad", """
SELECT event_id, lpad(CAST(event_id * 997 AS VARCHAR), CAST(greatest(6, length(CAST(event_id * 997 AS VARCHAR))) AS INT), '0') AS seq
FROM events""")
def padded(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", fn.zero_pad(F.col("event_id") * 997).alias("seq"))


@query("F17_date_from_name", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('day', ts) END AS day FROM events""")
def named_dates(spark, sf_dir):
    stem = F.when(F.col("event_type") == "error", "other-").otherwise("trade_")
    name = F.concat(stem, F.date_format("ts", "yyyyMMdd"), F.lit("_000001.txt"))
    return events(spark, sf_dir).select("event_id", fn.date_from_name(name, "trade_").alias("day"))


@query("F18_ipv4_number", f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE {EVENT_IP_SQL} END AS number FROM events""")
def addresses(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.concat(event_ip(), F.lit("9999"))).otherwise(event_ip())
    return events(spark, sf_dir).select("event_id", fn.ipv4_number(text).alias("number"))


@query("F19_signature", "SELECT doc_id, md5(text) AS signature FROM documents")
def signatures(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.signature("text").alias("signature"))


@query("F20_vector_dim", "SELECT vec_id, CAST(len(embedding) AS INT) AS dim FROM embeddings")
def dims(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("dim"))
