import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.operators import changes as ch

SCHEMA = "op string, seq int, id int, v string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "null")], "id int, v string")


def test_last_change_of_a_key_decides(spark, target):
    changes = spark.createDataFrame(
        [("U", 1, 1, "x"), ("U", 3, 1, "y"), ("U", 2, 1, "z"), ("D", 4, 2, "b"), ("I", 5, 9, "n"), ("D", 6, 9, "n"),
         ("D", 1, 3, "c"), ("I", 2, 3, "again")], SCHEMA)
    out = ch.apply_changes(target, changes, ["id"])
    assert rows(out) == [(1, "y"), (3, "again"), (None, "null")]


def test_applying_twice_changes_nothing(spark, target):
    changes = spark.createDataFrame([("U", 1, 1, "x"), ("D", 2, 2, None), ("I", 3, 7, "n"), ("U", 4, None, "m")], SCHEMA)
    once = ch.apply_changes(target, changes, ["id"])
    assert rows(once) == [(1, "x"), (3, "c"), (7, "n"), (None, "m")]
    assert rows(ch.apply_changes(once, changes, ["id"])) == rows(once)


def test_strict_updates_need_a_row(spark, target):
    changes = spark.createDataFrame(
        [("U", 1, 1, "x"), ("U", 2, 8, "nobody"), ("I", 3, 9, "n"), ("U", 4, 9, "m"), ("D", 5, 2, None), ("U", 6, 2, "gone")], SCHEMA)
    assert rows(ch.apply_changes(target, changes, ["id"], strict=True)) == [(1, "x"), (3, "c"), (9, "m"), (None, "null")]


def statements(table, changes, strict):
    table = dict(table)
    for op, _, key, value in sorted(changes, key=lambda c: c[1]):
        if op == "D":
            table.pop(key, None)
        elif op == "I" or not strict or key in table:
            table[key] = value
    return table


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("IUD"), st.integers(0, 5)), max_size=25), st.booleans())
def test_equals_one_statement_after_the_other(spark, steps, strict):
    table = {0: "old0", 1: "old1", 2: "old2"}
    changes = [(op, i, key, f"v{i}") for i, (op, key) in enumerate(steps)]
    target = spark.createDataFrame(list(table.items()), "id int, v string")
    frame = spark.createDataFrame(changes, SCHEMA)
    got = ch.apply_changes(target, frame, ["id"], strict=strict)
    assert dict(map(tuple, got.collect())) == statements(table, changes, strict)


def test_a_small_batch_does_not_shuffle_the_target(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    changes = spark.createDataFrame([("U", 1, 5, 1.0)], "op string, seq int, o_orderkey bigint, o_totalprice double")
    out = ch.apply_changes(target, changes, ["o_orderkey"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_compound_keys_and_extra_columns(spark):
    target = spark.createDataFrame([(1, "x", 1.0)], "a int, b string, v double")
    changes = spark.createDataFrame([("U", 1, 1, "x", 2, "e"), ("I", 2, 1, "y", 3, "e")], "op string, seq int, a int, b string, v int, extra string")
    out = ch.apply_changes(target, changes, ["a", "b"])
    assert rows(out) == [(1, "x", 2.0), (1, "y", 3.0)] and out.columns == ["a", "b", "v"]


def test_marks_and_diffs(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, v int")
    from pyspark.sql import functions as F

    assert rows(ch.mark(df, {"D": F.col("v") > 20, "U": F.col("v") > 1}).select("id", "_op")) == [(1, "I"), (2, "U"), (3, "D")]
    images = spark.createDataFrame([((1, None), (1, "x")), ((1, None), (2, None)), ((1, "x"), (1, "x"))],
                                   "before struct<a:int,b:string>, after struct<a:int,b:string>")
    assert [r.changed for r in ch.changed_fields(images, ["a", "b"]).collect()] == [["b"], ["a"], []]


def test_flat_changes_need_their_key(spark):
    df = spark.createDataFrame([("I", 1, None, (1,))], "op string, seq int, before struct<a:int>, after struct<a:int>")
    assert rows(ch.flatten_changes(df, ["a"])) == [("I", 1, 1)]
    with pytest.raises(ValueError):
        ch.flatten_changes(df, ["z"])
