from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.session import stage


def test_every_key_counts_as_often_as_it_was_sent(spark):
    keys = spark.range(1590).select(F.concat(F.lit("Jack_"), F.col("id").cast("string")).alias("name"))
    sent = keys.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(10))))
    out = mt.key_metric(sent, "name")
    assert out.count() == 1590 and out.filter("count <> 10").count() == 0


def test_null_and_empty_keys_share_the_default(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("a",)], "k string")
    assert rows(mt.key_metric(df, "k", "none")) == [(" ", 1), ("a", 1), ("none", 2)]


def test_a_hot_key_is_one_row_per_map_task(spark):
    df = spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    out = mt.key_metric(df, "k")
    assert out.filter("metric = 'hot'").first()["count"] == 20_000
    assert "partial_count" in out._jdf.queryExecution().executedPlan().toString()


def test_several_metrics_shuffle_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    specs = [mt.MetricSpec("a", "event_type", "day"), mt.MetricSpec("b", "user_id", "month"), mt.MetricSpec("c", "user_id")]
    plan = mt.multi_metric(events, specs, "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "props" not in plan.split("ReadSchema")[1]


def test_a_window_needs_a_time():
    with pytest.raises(ValueError):
        mt.MetricSpec("a", "k", "day").entry(None)


def test_metric_filters_and_own_columns(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("b", 3, None)], "k string, id int, v double")
    specs = [
        mt.MetricSpec("sum", "k", aggs={"total": F.sum("v")}),
        mt.MetricSpec("big", "k", where=F.col("v") > 6, first={"first_id": "id"}, order=["id"]),
    ]
    out = mt.multi_metric(df, specs).select("metric_type", "metric", "count", "total", "first_id")
    assert rows(out) == [("big", "a", 1, None, 2), ("sum", "a", 2, 12.0, None), ("sum", "b", 1, None, None)]


def test_runs_add_up_or_start_over(spark):
    first = spark.createDataFrame([("a", 2), ("b", 1)], "metric string, count bigint")
    second = spark.createDataFrame([("a", 5), ("c", 1)], "metric string, count bigint")
    assert rows(mt.run_metric(second, first, ["metric"], reset=False)) == [("a", 7), ("b", 1), ("c", 1)]
    assert rows(mt.run_metric(second, first, ["metric"], reset=True)) == [("a", 5), ("c", 1)]


def test_counters_add_up(spark):
    rows_, seen = mt.counted(spark.range(10), F.col("id") < 3, F.col("id") < 5)
    stage(rows_)
    assert seen.get == {"total": 10, "success": 5, "failed": 3, "ignored": 2}


def behaviour_model(events):
    """The accumulator as a loop: one record after the other."""
    level, text = 0, None
    for kind, word in events:
        if kind == mt.PAGE_EVENT:
            level += 1
        elif kind in (mt.SEARCH_EVENT, mt.SHOW_EVENT) and word is not None:
            if text is None:
                text = word
            elif word not in text:
                text += ";" + word
    return level, text


WORDS = st.sampled_from(["a", "ab", "b", "abc", "b;a", "", "c;ab", ";", None])
KINDS = st.sampled_from([mt.PAGE_EVENT, mt.SEARCH_EVENT, mt.SHOW_EVENT, "other"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(KINDS, WORDS), min_size=1, max_size=12), min_size=1, max_size=12))
def test_behaviour_equals_the_loop(spark, users):
    day = datetime(2024, 3, 1)
    data = [
        (f"u{u}", day.replace(second=i // 2), i, kind, word if kind == mt.SEARCH_EVENT else None,
         word if kind == mt.SHOW_EVENT else None, day, day)
        for u, events in enumerate(users) for i, (kind, word) in enumerate(events)
    ]
    schema = ("USER string, EVENT_TIME timestamp_ntz, no int, EVENT_KEY string, searchWords_var string, XY_SCENE string, "
              "CREATE_TIME timestamp_ntz, UPDATE_TIME timestamp_ntz")
    df = spark.createDataFrame(data, schema).repartition(3)
    got = {r.metric: (r.active_level, r.qry_msg, r.events) for r in mt.user_behaviour_metric(df, ["EVENT_TIME", "no"]).collect()}
    assert got == {f"u{u}": (*behaviour_model(events), len(events)) for u, events in enumerate(users)}


def test_behaviour_takes_the_head_of_the_first_record(spark):
    schema = ("USER string, EVENT_TIME timestamp_ntz, EVENT_KEY string, searchWords_var string, XY_SCENE string, "
              "CREATE_TIME timestamp_ntz, UPDATE_TIME timestamp_ntz")
    t = [datetime(2024, 3, 1, h) for h in range(4)]
    data = [("u", t[2], "x", None, None, t[0], t[0]), ("u", t[1], mt.SEARCH_EVENT, "w", None, t[3], t[2])]
    row = mt.user_behaviour_metric(spark.createDataFrame(data, schema), ["EVENT_TIME"]).first()
    assert (row.mobile, row.create_time, row.update_time) == ("u", t[3], t[2])


def test_busy_user_arrives_as_vocabulary(spark):
    """A user with most rows and few words: the second step sees words, not rows."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.lit("u").alias("USER"), F.lit("2024-03-01").cast("timestamp_ntz").alias("EVENT_TIME"), "id",
        F.lit(mt.SEARCH_EVENT).alias("EVENT_KEY"), (F.col("id") % 5 + 10).cast("string").alias("searchWords_var"),
        F.lit(None).cast("string").alias("XY_SCENE"), F.lit(None).cast("timestamp_ntz").alias("CREATE_TIME"),
        F.lit(None).cast("timestamp_ntz").alias("UPDATE_TIME"),
    )
    row = mt.user_behaviour_metric(df, ["id"]).first()
    assert (row.qry_msg, row.events) == ("10;11;12;13;14", 30_000)
