import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from tidemark.operators import transforms as tr


def cells(*values):
    return ",".join(values)


GOOD = ["$page", "2024-01-02 03:04:05+08:00", "u1"] + [f"c{i}" for i in range(3, 16)]


def with_cell(index, value):
    return cells(*[value if i == index else c for i, c in enumerate(GOOD)])


@pytest.mark.parametrize(("line", "reason"), [
    (cells(*GOOD), None),
    (cells(*GOOD[:15]), None),
    (cells(*GOOD[:14]), "cells"),
    ("a,b,c", "cells"),
    ("", "blank"),
    ("   ", "blank"),
    (None, "blank"),
    (with_cell(2, "user"), "header"),
    (with_cell(2, "139-1"), "user"),
    (with_cell(3, '"open'), "parse"),
    (with_cell(1, "yesterday"), "time"),
    (with_cell(0, tr.ENCODED_USER_EVENT).replace("u1", "%%%"), "encoding"),
    (with_cell(0, tr.ENCODED_USER_EVENT).replace("u1", "dTE="), None),
])
def test_clean_behaviour_reasons(spark, line, reason):
    df = spark.createDataFrame([(line,)], "line string")
    row = tr.clean_behaviour(df, "line").first()
    assert row["reject_reason"] == reason
    if reason is None:
        assert row["USER"] == "u1"
        assert row["USER_AGENT"] == (GOOD[15] if line.count(",") == 15 else None)


@pytest.mark.parametrize(("line", "wanted", "count"), [
    ('a,"b,c",,"d ""e""",f', ("a", "b,c", None, 'd "e"', "f"), 5),
    (",x,", (None, "x", None, None, None), 3),
    ('"a "",b,"" c",z', ('a ",b," c', "z", None, None, None), 2),
    ("a,b,c,d,e,f,g", ("a", "b", "c", "d", "e"), 7),
    ("one", ("one", None, None, None, None), 1),
])
def test_csv_cells_follow_the_quotes(spark, line, wanted, count):
    found, outside = tr.csv_cells(F.col("l"), ["a", "b", "c", "d", "e"])
    df = spark.createDataFrame([(line,)], "l string")
    row = df.select(found.alias("c"), tr.cell_count(outside).alias("n")).first()
    assert (tuple(row.c), row.n) == (wanted, count)


def test_record_value_beats_constant(spark):
    df = spark.createDataFrame([(1,)], "id int")
    row = tr.derive(df, {"author": "a", "n": 1}, author=F.lit("b"), m=F.col("n") + 1).first()
    assert (row.author, row.m) == ("b", 2)


def test_drop_where_keeps_the_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert rows(tr.drop_where(df, F.col("x") > 3)) == [(1,), (None,)]


def test_split_valid_reports_the_first_rule(spark):
    df = spark.createDataFrame([(1,), (12,), (30,), (None,)], "x int")
    ok, bad = tr.split_valid(df, [("large", F.col("x") > 20), ("medium", F.col("x") > 10)])
    assert rows(ok) == [(1,), (None,)]
    assert rows(bad) == [(12, "medium"), (30, "large")]


def test_merge_struct_override(spark):
    df = spark.createDataFrame([(1, "a", (9, None, "z"))], "id int, t string, s struct<id:int,t:string,u:string>")
    assert tr.merge_struct(df, "s").first().asDict() == {"id": 1, "t": "a", "u": "z"}
    assert tr.merge_struct(df, "s", override=True).first().asDict() == {"id": 9, "t": "a", "u": "z"}


def test_merge_map(spark):
    df = spark.createDataFrame([(1, None, {"t": "a", "u": "b"})], "id int, t string, m map<string,string>")
    assert tr.merge_map(df, "m", ["t", "u"]).first().asDict() == {"id": 1, "t": "a", "u": "b"}


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "LOG_ID int, Oper_module int")
    assert tr.name_style(df, camel=True, lower=True).columns == ["logId", "operModule"]
    assert tr.name_style(df, lower=True).columns == ["log_id", "oper_module"]
    assert tr.name_style(df, upper=True).columns == ["LOG_ID", "OPER_MODULE"]
    assert tr.name_style(df).columns == ["LOG_ID", "Oper_module"]


def test_conform_makes_bad_values_null(spark):
    df = spark.createDataFrame([("7", "x"), ("seven", "y")], "n string, extra string")
    schema = T.StructType().add("n", "integer").add("missing", "date")
    assert rows(tr.conform(df, schema)) == [(7, None), (None, None)]


def test_branches(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "tbl string, v int")
    branches = {"a": tr.Branch("A", {"x": 1}), "b": tr.Branch("B", {"x": 2}, ["v"])}
    assert rows(tr.transform_by(df, "tbl", branches)) == [("a", 1, "A", 1), ("b", None, "B", 2), ("c", 3, None, None)]
    assert tr.branch_frame(df, "tbl", "b", branches["b"]).columns == ["tbl", "x"]


def test_split_records_drops_records_without_items(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, items array<string>")
    assert rows(tr.split_records(df, F.col("items"), keep=["id"])) == [(1, "x"), (1, "y")]
    assert rows(tr.split_records(df, F.col("items"), keep=["id"], position="pos")) == [(1, 0, "x"), (1, 1, "y")]
