"""A table of hash buckets: changes put batch by batch, merged on read."""

import random
from pathlib import Path

import pytest
from conftest import rows

from tidemark.operators.changes import apply_changes
from tidemark.sinks.buckets import BucketTable, stream_into
from tidemark.sinks.commits import CommitConflict
from tidemark.streaming import drain, file_stream

CHANGES = "id bigint, v string, op string, seq bigint"


def make(spark, tmp_path, **how):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    return BucketTable(spark, str(tmp_path / "table"), schema, ["id"], **{"buckets": 8, "most_deltas": 3} | how)


def files(tmp_path):
    return {str(p) for p in Path(tmp_path / "table").rglob("*.parquet") if p.is_file()}


def test_random_batches_equal_all_changes_at_once(spark, tmp_path):
    rng = random.Random(1)
    table = make(spark, tmp_path)
    start = [(i, f"old{i}") for i in range(30)] + [(None, "null key")]
    table.load(spark.createDataFrame(start, "id bigint, v string"))
    target = spark.createDataFrame(start, "id bigint, v string")
    assert rows(table.read()) == rows(target)
    done = []
    for batch in range(5):
        part = [(rng.choice([*range(40), None]), f"b{batch}.{i}", rng.choice("IUD"), batch * 100 + rng.randrange(100)) for i in range(12)]
        # One change per key and seq; some come before changes of earlier batches.
        part = list({(r[0], r[3]): r for r in part}.values()) + [(7, f"late{batch}", "U", 50 - batch)]
        done += part
        table.put(spark.createDataFrame(part, CHANGES))
        assert rows(table.read()) == rows(apply_changes(target, spark.createDataFrame(done, CHANGES), ["id"]))
    table.compact()
    expected = rows(apply_changes(target, spark.createDataFrame(done, CHANGES), ["id"]))
    assert rows(table.read()) == expected
    table.compact([b for b in table._log().latest()[1]["buckets"]], forget_deletes=True)
    assert rows(table.read()) == expected


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = make(spark, tmp_path, buckets=100, most_deltas=1)
    table.load(spark.range(5000).selectExpr("id", "'old' AS v"))
    before = files(tmp_path)
    one = spark.createDataFrame([(17, "new", "U", 1)], CHANGES)
    table.put(one)
    state = table._log().latest()[1]
    bases = {e["base"] for e in state["buckets"].values()}
    assert len(bases) == 2 and all(not e["deltas"] for e in state["buckets"].values())
    # One file of changes and one new base; the others are where they were.
    assert len(files(tmp_path) - before) == 2
    assert table.read().where("v = 'new'").count() == 1 and table.read().count() == 5000


def test_replays_and_writers(spark, tmp_path):
    table = make(spark, tmp_path)
    assert rows(table.read()) == []
    one = spark.createDataFrame([(1, "a", "I", 1)], CHANGES)
    assert table.put(one, writer="feed", batch_id=0) and not table.put(one, writer="feed", batch_id=0)
    assert table.put(spark.createDataFrame([(1, "b", "U", 2)], CHANGES), writer="other", batch_id=0)
    assert rows(table.read()) == [(1, "b")]
    # A second writer that has read the same commit fails, and leaves nothing.
    version, state = table._log().latest()
    table._log().commit(version + 1, state)
    before = files(tmp_path)
    with pytest.raises(CommitConflict):
        table._commit(version, dict(state), [])
    assert files(tmp_path) == before and rows(table.read()) == [(1, "b")]


def test_a_feed_is_streamed_into_the_table(spark, tmp_path):
    table, path, checkpoint = make(spark, tmp_path), str(tmp_path / "in"), str(tmp_path / "ckpt")
    schema = "op string, seq bigint, before struct<id:bigint,v:string>, after struct<id:bigint,v:string>"
    for part in ([("I", 1, None, (1, "a")), ("I", 2, None, (2, "b"))], [("U", 3, (1, "a"), (1, "c")), ("D", 4, (2, "b"), None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        drain(stream_into(file_stream(spark, path, spark.read.parquet(path).schema), table, checkpoint, "feed"))
    assert rows(table.read()) == [(1, "c")]
    assert not table.put(spark.createDataFrame([(9, "x", "I", 9)], CHANGES), writer="feed", batch_id=1)
