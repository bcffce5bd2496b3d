"""Keyed state, end marks and closed windows of streams."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.metrics import MANY_WORDS, _join_new_words, join_new_words, user_behaviour_metric
from tidemark.streaming import EndMarks, closed_rows, drain, file_stream, stream_key_time_metric, write_closed
from tidemark.streaming.state import stream_behaviour

SCHEMA = "id bigint, u string, kind string, word string, ts timestamp_ntz"
HOW = {
    "order_cols": ["ts", "id"], "user": "u", "time": "ts", "event": "kind", "search_word": "word", "scene": "word", "create_time": "ts",
    "update_time": "ts", "events": ("page", "search", "show"),
}


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def write(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


class Run:
    """One stream over a folder, run by run."""

    def __init__(self, spark, tmp_path, closing):
        self.spark, self.closing = spark, closing
        self.source, self.out, self.checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
        self.marks = EndMarks(spark, str(tmp_path / "marks"))

    def __call__(self, data=()):
        if data:
            write(self.spark, self.source, data)
        stream = self.closing(self.marks.attach(file_stream(self.spark, self.source, self.spark.read.parquet(self.source).schema), "ts"))
        query = write_closed(stream, self.out, self.checkpoint)
        drain(query)
        assert query.exception() is None
        self.state_rows = sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])
        return closed_rows(self.spark, self.out, stream.schema).drop("batch_id")


def test_the_last_window_comes_with_the_flush_only(spark, tmp_path):
    run = Run(spark, tmp_path, lambda sdf: stream_key_time_metric(sdf, "u", "ts", "hour", "10 minutes"))
    assert rows(run([(1, "a", "", "", at(0)), (2, "a", "", "", at(2.5))])) == [("a", at(0), 1)]
    assert rows(run([(3, "a", "", "", at(2.9)), (4, None, "", "", at(2.9))])) == [("a", at(0), 1)]
    run.marks.put(at(2.9), 3600, 600)
    assert rows(run()) == [("a", at(0), 1), ("a", at(2), 2), ("unknown", at(2), 1)]
    assert run.state_rows == 0
    # The stream goes on behind the mark; what comes for a window that was given out is late.
    run([(5, "a", "", "", at(2.95)), (6, "b", "", "", at(5))])
    run.marks.put(at(5), 3600, 600)
    assert rows(run()) == [("a", at(0), 1), ("a", at(2), 2), ("b", at(5), 1), ("unknown", at(2), 1)]


def behaviour(n, day):
    words = ("shoes", "red shoes", "hat", None, "a hat;b", "shoe")
    return [(day * 1000 + i, f"u{i % 3}", ("page", "search", "show", "other")[i % 4], words[i * 7 % 6], at(24 * day + (i * 5 % 23))) for i in range(n)]


def test_behaviour_as_state_equals_the_batch(spark, tmp_path):
    run = Run(spark, tmp_path, lambda sdf: stream_behaviour(sdf, **HOW))
    days = [behaviour(60, 0), behaviour(40, 1), behaviour(50, 2)]
    whole = user_behaviour_metric(spark.createDataFrame(sum(days, []), SCHEMA), **{k: v for k, v in HOW.items() if k != "order_cols"}, order_cols=HOW["order_cols"])
    expected = rows(whole.select("metric", "data_time", "mobile", "create_time", "update_time", "active_level", "qry_msg", "events"))
    # Records of an open day come in several runs, the earlier ones last.
    assert rows(run(days[0][30:])) == []
    assert rows(run(days[0][:30])) == []
    open_rows = run.state_rows
    assert rows(run(days[1])) == [r for r in expected if r[1] == at(0)]
    assert run.state_rows <= open_rows
    run(days[2])
    run.marks.put(at(72), 24 * 3600)
    assert rows(run()) == expected
    assert run.state_rows == 0


@pytest.mark.parametrize("words", [
    [], ["a"], ["", "a", ""], ["ab", "b", "abc", "c", "bc;a"], ["x;y", "x", "y", ";", "x;y;z"], ["a", "b", "a;b", "b;a"], ["a", "aa", "aaa"], ["é", "日本", "本", "é日"],
])
def test_words_are_joined_as_one_by_one(words):
    text = None
    for word in words:
        text = word if text is None else text if word in text else f"{text};{word}"
    assert join_new_words(words) == text


def test_days_of_many_and_of_few_words_agree(spark):
    data = [[f"w{i * 7919 % 1000}" for i in range(n)] for n in (0, 3, MANY_WORDS - 1, MANY_WORDS, 3 * MANY_WORDS)]
    df = spark.createDataFrame([(i, [(w,) for w in dict.fromkeys(x)]) for i, x in enumerate(data)], "i int, said array<struct<word:string>>")
    got = [r.text for r in df.select("i", _join_new_words("said").alias("text")).orderBy("i").collect()]
    assert got == [join_new_words(list(dict.fromkeys(x))) for x in data]


def test_a_stream_of_many_short_days_keeps_no_state_in_python(spark, tmp_path):
    """Every user's day costs a few rows of state, not calls to a Python worker for each of its records."""
    run = Run(spark, tmp_path, lambda sdf: stream_behaviour(sdf, **HOW))
    data = [(i, f"u{i % 700}", ("page", "search", "show")[i % 3], f"w{i % 5}", at(24 * (i // 2100) + i % 23)) for i in range(4200)]
    whole = user_behaviour_metric(spark.createDataFrame(data, SCHEMA), **HOW)
    run(data)
    run.marks.put(at(47), 24 * 3600)
    assert rows(run()) == rows(whole.select("metric", "data_time", "mobile", "create_time", "update_time", "active_level", "qry_msg", "events"))
    assert run.state_rows == 0
    stream = stream_behaviour(file_stream(spark, run.source, spark.read.parquet(run.source).schema), **HOW)
    assert "InPandas" not in stream._jdf.queryExecution().analyzed().toString()
