"""Queries for scans and sources."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import format_time, ntz, to_millis
from tidemark.plans.registry import CHANGES_SQL, order_changes, query, table
from tidemark.session import shared_folder
from tidemark.sinks.records import encode_messages
from tidemark.sources.files import (
    archive_scan,
    csv_scan,
    multiline_scan,
    read_selected,
    select_files,
    text_lines,
    with_file_meta,
    with_pointer,
)
from tidemark.sources.records import (
    Cell,
    change_feed,
    decode_messages,
    history_then_tail,
    json_scan,
    line_filter,
    multiline_records,
    split_scan,
    truncate_bytes,
)
from tidemark.sources.state import StateTable
from tidemark.sources.tail import tail_files
from tidemark.sources.tables import (
    expr_scan,
    filter_scan,
    incremental_scan,
    incremental_scan_millis,
    incremental_scan_ts,
    named_query,
    page,
    page_after,
    slices_union,
    sql_scan,
)
from tidemark.streaming import file_stream, run_increment

NOW = datetime(2024, 1, 25)
LAST = datetime(2024, 1, 10)

NAMED = {
    "condition": "value >= #[low] and ts > #[last,type=timestamp]",
    "byType": """
        select event_type, count(*) as n, min(event_id) as first_id ## remarks are dropped
        from events where @{condition} or user_id = #[user] group by event_type""",
    "export": "select event_id, ts, value from events order by event_id limit 10",
}


@query("S1_sql_scan", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 1")
def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("td_sm_log")
    return sql_scan(spark, "select event_id, user_id, event_type, value from td_sm_log where value > 1")


@query("S2_named_query", """
SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events
WHERE (value >= 20.0 AND ts > TIMESTAMP '2024-01-10') OR user_id = 7 GROUP BY event_type""")
def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_query(spark, NAMED, "byType", {"events": table(spark, sf_dir, "events")},
                       low=20.0, last=LAST, user=7)


@query("S3_incremental_scan", """
SELECT event_id, event_type, value FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)""")
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] // 2
    return incremental_scan(events, "event_id", last).rows.select("event_id", "event_type", "value")


@query("S4_incremental_scan_ts", """
SELECT event_id, ts FROM events
WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-25' - INTERVAL 3600 SECOND""")
def incremental_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_scan_ts(table(spark, sf_dir, "events"), "ts", LAST, NOW, 3600).rows.select("event_id", "ts")


@query("S5_incremental_scan_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events
WHERE epoch_us(ts) // 1000 > epoch_us(TIMESTAMP '2024-01-10') // 1000
  AND epoch_us(ts) // 1000 <= epoch_us(TIMESTAMP '2024-01-25') // 1000 - 60000""")
def incremental_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = table(spark, sf_dir, "events").select("event_id", to_millis("ts").alias("ms"))
    start = datetime(1970, 1, 1)
    last, now = (int((t - start) / timedelta(milliseconds=1)) for t in (LAST, NOW))
    return incremental_scan_millis(millis, "ms", last, now, 60).rows


@query("S6_incremental_scan_local_time", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""")
def incremental_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return incremental_scan_ts(orders, "o_orderdate", datetime(1998, 1, 1)).rows.select("o_orderkey", "o_orderdate")


@query("S7_incremental_state", """
SELECT CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 0 WHEN ts <= TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS run,
       event_type, count(*) AS n, max(ts) AS mark
FROM events GROUP BY ALL""")
def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the same job. Each starts at the stored mark."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    out = shared_folder(spark, "runs")
    state = StateTable(spark, shared_folder(spark, "state"))
    for run, now in enumerate((LAST, datetime(2024, 1, 20), datetime(2100, 1, 1))):
        run_increment(
            lambda last, now=now: incremental_scan_ts(events, "ts", last, now),
            lambda rows, run=run: rows.write.parquet(f"{out}/run={run}"),
            state, "events-copy",
        )
    copied = spark.read.schema("event_id bigint, ts timestamp_ntz, event_type string, run int").parquet(out)
    return copied.groupBy("run", "event_type").agg(F.count("*").alias("n"), F.max("ts").alias("mark"))


@query("S8_filter_scan", """
SELECT event_id, ts, value FROM events
WHERE event_type = 'click' AND value >= 5.0 AND ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-25'""")
def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = {"value": {"gte": 5.0}, "ts": {"gt": ntz(LAST), "lte": ntz(NOW)}}
    return filter_scan(table(spark, sf_dir, "events"), {"event_type": "click"}, ranges).select("event_id", "ts", "value")


@query("S9_slice_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return slices_union(orders, "o_orderkey", 3)


@query("S10_page", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 50 OFFSET 200")
def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 200, 50)


@query("S10_page_after", """
SELECT event_id, ts FROM events WHERE (ts, event_id) > (TIMESTAMP '2024-01-15', 0) ORDER BY ts, event_id LIMIT 50""")
def paged_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return page_after(events, ["ts", "event_id"], ["2024-01-15 00:00:00", 0], 50)


@query("S11_expr_scan", "SELECT event_id, user_id FROM events WHERE value > 10 AND event_type <> 'error'")
def by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expr_scan(table(spark, sf_dir, "events"), "value > 10 and event_type <> 'error'", ["event_id", "user_id"])


@query("S12_csv_scan", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props, CAST(NULL AS VARCHAR) AS notexist FROM events""")
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    events.write.option("header", True).option("escape", '"').csv(path)
    return csv_scan(spark, path, {0: "event_id", 2: "event_type", 3: "props", 16: "notexist"}, skip_lines=1)


@query("S13_split_scan", """
SELECT event_id, event_type, value, date_trunc('second', ts) AS ts, 'none' AS extra, CAST(NULL AS INT) AS bad FROM events""")
def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    line = F.concat_ws(";", "event_id", "event_type", "value", format_time("ts", "yyyy-MM-dd HH:mm:ss"))
    cells = [
        Cell(0, "event_id", "bigint"),
        Cell(1, "event_type"),
        Cell(2, "value", "double"),
        Cell(3, "ts", "timestamp_ntz", fmt="yyyy-MM-dd HH:mm:ss"),
        Cell(9, "extra", default="none"),
        Cell(1, "bad", "int"),
    ]
    return split_scan(events.select(line.alias("line")), "line", ";", cells)


@query("S14_json_scan", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, CAST(json_extract(props, '$.k') AS INT) AS message_k
FROM events""")
def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    nested = json_scan(events.withColumn("raw", F.col("props")), "raw", "k int", root_level=False)
    flat = json_scan(nested, "props", "k int")
    return flat.select("event_id", "k", F.col("message.k").alias("message_k"))


@query("S15_multiline_records", r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents),
heads AS (
  SELECT doc_id, line_no, line,
         sum(CASE WHEN line_no > 1 AND regexp_matches(line, '^[A-Z]') THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY line_no) AS record_no
  FROM lines)
SELECT doc_id, CAST(record_no AS INT) AS record_no, md5(string_agg(line, chr(10) ORDER BY line_no)) AS record
FROM heads GROUP BY doc_id, record_no""")
def multiline_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return multiline_records(docs, "text", "^[A-Z]").select(
        "doc_id", "record_no", F.md5(F.col("record").cast("binary")).alias("record")
    )


@query("S15_multiline_scan", "SELECT event_id, event_type, props FROM events")
def multiline_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log records of three lines, read back by their heads."""
    path = shared_folder(spark, "log")
    events = table(spark, sf_dir, "events")
    stamp = F.concat(F.lit("["), format_time("ts", "yyyy-MM-dd HH:mm:ss:SSS"), F.lit("] "))
    record = F.concat(stamp, F.col("event_id").cast("string"), F.lit("\n  "), "event_type", F.lit("\n  "), "props")
    events.select(record).write.text(path)
    head = r"^\[\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}:\d{3}\]"
    records = multiline_scan(spark, path, head)
    lines = F.split("record", "\n")
    return records.select(
        F.element_at(F.split(F.get(lines, F.lit(0)), " "), -1).cast("bigint").alias("event_id"),
        F.trim(F.get(lines, F.lit(1))).alias("event_type"),
        F.trim(F.get(lines, F.lit(2))).alias("props"),
    )


@query("S16_line_filter", """
SELECT doc_id, lang FROM documents
WHERE (regexp_matches(text, 'ation') OR regexp_matches(text, '\\bthe\\b')) AND NOT regexp_matches(text, '[0-9]{3}')"""
       .replace("\\\\", "\\"))
def lines_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_filter(docs, "text", ["ation", r"\bthe\b"], ["[0-9]{3}"]).select("doc_id", "lang")


@query("S17_truncate_bytes", """
WITH chars AS (
  SELECT doc_id, i, substr(text, i, 1) AS c
  FROM documents, LATERAL (SELECT unnest(range(1, least(length(text), 101) + 1)) AS i)),
sized AS (SELECT doc_id, i, c, sum(strlen(c)) OVER (PARTITION BY doc_id ORDER BY i) AS bytes FROM chars)
SELECT doc_id, string_agg(c, '' ORDER BY i) AS text FROM sized WHERE bytes <= 101 GROUP BY doc_id""")
def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncate_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 101)


@query("S17_start_pointer", """
SELECT CAST(sum(strlen(event_id || ' ' || props) + 1) AS BIGINT) AS bytes, count(*) AS lines FROM events""")
def byte_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line starts where the one before it ended, up to the size of its file."""
    path = shared_folder(spark, "pointer")
    table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_id", "props")).write.text(path)
    lines = with_pointer(text_lines(spark, path))
    starts = lines.groupBy("file_path", "pointer").agg(F.max(F.col("pointer") + F.col("line_bytes") + 1).alias("end"))
    files = starts.groupBy("file_path").agg(F.max("end").alias("size"), F.count("*").alias("starts"))
    return files.agg(F.sum("size").alias("bytes"), F.sum("starts").alias("lines"))


@query("S18_select_files", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    files = select_files(spark, path, suffix=".parquet", regex=r".+\.parquet", min_age_s=1, now=datetime(2100, 1, 1))
    events = read_selected(spark, files, table(spark, sf_dir, "events").schema)
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


@query("S19_file_meta", "SELECT 'events.parquet' AS source, true AS has_size, count(*) AS n FROM events")
def file_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_file_meta(table(spark, sf_dir, "events"))
    source = F.regexp_extract("file_path", r"([^/]+\.parquet)", 1)
    return events.groupBy(source.alias("source"), (F.col("file_size") > 0).alias("has_size")).agg(F.count("*").alias("n"))


@query("S20_text_scan", """
SELECT md5(line) AS line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY line""")
def other_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written in GB18030 and read back."""
    @F.pandas_udf("binary")
    def encode(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t.encode("gb18030"))

    path = shared_folder(spark, "gb18030")
    table(spark, sf_dir, "documents").select(encode("text").cast("string")).write.text(path)
    lines = text_lines(spark, path, "GB18030")
    return lines.groupBy(F.md5(F.col("line").cast("binary")).alias("line")).agg(F.count("*").alias("n"))


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream. The glob lets one file stand for a folder."""
    schema = table(spark, sf_dir, name).schema
    return file_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parque[t]", schema, max_files=64)


@query("S21_file_stream", "SELECT event_id, event_type FROM events")
def streamed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "checkpoint")
    rows = stream_of(spark, sf_dir, "events").select("event_id", "event_type")
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def append_lines(lines: DataFrame, folder: str, run: int) -> None:
    """Append to the files of a folder what comes by ``run``, and the first half of the line after that.

    ``lines`` has ``file``, ``run``, ``place`` and ``line``; a task writes its files one after another. What a
    file has already is left out, so a repeated task changes nothing.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, have, at, out, done = None, 0, 0, None, False
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if out is not None:
                        out.close()
                    name, at, done = row["file"], 0, False
                    files, place = pfs.FileSystem.from_uri(folder) if "://" in folder else (pfs.LocalFileSystem(), folder.removeprefix("file:"))
                    files.create_dir(place)
                    path = f"{place}/part-{name}.log"
                    have = max(files.get_file_info(path).size or 0, 0)
                    out = files.open_append_stream(path)
                data = row["line"].encode()
                if row["run"] > run:
                    data, done = b"" if done else data[:len(data) // 2], True
                out.write(data[max(0, have - at):])
                at += len(data)
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name or 0], pa.int64())], names=["file"])

    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(parts, "file").sortWithinPartitions("file", "run", "place")
    dealt.mapInArrow(write, "file bigint").write.format("noop").mode("overwrite").save()


@query("S21_tail_files", """
SELECT event_id, event_type, user_id, epoch_us(ts) AS us FROM events""")
def tailed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of records of two lines that grows between three runs; each run ends within a record."""
    events = table(spark, sf_dir, "events")
    text = F.concat(
        F.lit("["), F.unix_micros(F.col("ts").cast("timestamp")).cast("string"), F.lit("] "), F.col("event_id").cast("string"), F.lit(";"), F.col("event_type"),
        F.lit("\n  user "), F.col("user_id").cast("string"), F.lit("\n"),
    )
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = events.select(
        F.pmod(F.xxhash64("event_id"), F.lit(files)).alias("file"), (F.col("event_id") % 3).alias("run"), F.col("event_id").alias("place"), text.alias("line"),
    )
    folder, out, checkpoint = (shared_folder(spark, n) for n in ("growing", "records", "checkpoint"))
    for run in range(3):
        append_lines(lines, folder, run)
        # In the last run the files are at rest, so their last records are whole.
        stream = tail_files(spark, folder, r"part-\d+\.log", r"^\[\d+\] ", idle_s=0 if run == 2 else None).select("record")
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    part = F.regexp_extract
    record = F.col("record")
    return spark.read.schema("record string").parquet(out).select(
        part(record, r"\] (\d+);", 1).cast("bigint").alias("event_id"), part(record, r";(.*)", 1).alias("event_type"),
        part(record, r"\n  user (\d+)$", 1).cast("bigint").alias("user_id"), part(record, r"^\[(\d+)", 1).cast("bigint").alias("us"),
    )


@query("S22_archive_scan", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, len(string_split(text, chr(10))) AS n,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents)
SELECT 'doc-' || doc_id || '.txt' AS member, i - 1 AS line_no, md5(line) AS line FROM lines WHERE i < n OR line <> ''""")
def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into zip files, some hundred per file, and read back line by line."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, data = batch.slice(at, 500).to_pydict(), io.BytesIO()
                with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
                    for doc_id, text in zip(part["doc_id"], part["text"]):
                        archive.writestr(f"doc-{doc_id}.txt", text)
                yield pa.RecordBatch.from_arrays([pa.array([data.getvalue()], type=pa.binary())], names=["data"])

    path = shared_folder(spark, "archives")
    packed = table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(pack, "data binary")
    packed.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    lines = archive_scan(spark, f"{path}/*.txt", "zip", member_regex=r"^doc-\d+\.txt$")
    return lines.select("member", "line_no", F.md5(F.col("line").cast("binary")).alias("line"))


@query("S23_decode_messages", """
SELECT event_type AS topic, event_id AS key, user_id, value FROM events WHERE event_type IN ('click', 'view')""")
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    sent = encode_messages(events, "event_id", F.col("event_type"), ["user_id", "value"], key_type="long")
    return decode_messages(sent, "user_id bigint, value double", "long", topics=["click", "view"])


@query("S24_change_feed", f"""
WITH {CHANGES_SQL}
SELECT op, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM changes WHERE database = 'shop' AND tbl = 'orders' GROUP BY op""")
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = change_feed(order_changes(spark, sf_dir), ["shop.orders", "shop.nothing"])
    return shop.groupBy("op").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query("S25_history_then_tail", f"""
WITH {CHANGES_SQL}
SELECT op, seq, coalesce(a_key, b_key) AS o_orderkey FROM changes WHERE tbl = 'orders'""")
def history_and_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old changes up to the middle, a live feed that starts before it."""
    changes = change_feed(order_changes(spark, sf_dir), ["shop.orders"])
    key = F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey")
    changes = changes.select("op", "seq", key)
    top = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] * 3
    old, live = changes.filter(F.col("seq") <= top // 2), changes.filter(F.col("seq") > top // 4)
    return history_then_tail(old, live, "seq")
