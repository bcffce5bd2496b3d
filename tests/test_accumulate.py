import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import accumulate as ac


def spread():
    """Made in a function, so that the class travels with the job."""
    class Spread:
        def __init__(self):
            self.low, self.high, self.seen = None, None, set()

        def add(self, record):
            self.merge_value(record["v"])
            self.seen.add(record["w"])

        def merge_value(self, v):
            if v is not None:
                self.low = v if self.low is None else min(self.low, v)
                self.high = v if self.high is None else max(self.high, v)

        def merge(self, other):
            self.merge_value(other.low)
            self.merge_value(other.high)
            self.seen |= other.seen

        def result(self):
            return {"low": self.low, "high": self.high, "words": ",".join(sorted(w for w in self.seen if w))}

    return Spread


SCHEMA = "low bigint, high bigint, words string"


@pytest.mark.parametrize("held", [100_000, 2])
def test_equals_spark_aggregates(spark, monkeypatch, held):
    monkeypatch.setattr(ac, "KEYS_IN_TASK", held)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string"))
    df = spark.range(0, 600, 1, 4).select(hot.alias("k"), "id", F.col("id").alias("v"), (F.col("id") % 4).cast("string").alias("w"))
    got = ac.accumulate(df, ["k"], spread(), SCHEMA, ["v", "w"])
    words = F.array_join(F.sort_array(F.collect_set("w")), ",")
    assert rows(got) == rows(df.groupBy("k").agg(F.min("v"), F.max("v"), words))
    assert got.columns == ["k", "low", "high", "words"]


def test_null_keys_and_values(spark):
    large = 2**60 + 1
    data = [(None, large, None, "a"), (None, large, 5, "b"), ("x", None, None, None), ("x", None, large, None)]
    df = spark.createDataFrame(data, "k string, n bigint, v bigint, w string").repartition(3)
    got = rows(ac.accumulate(df, ["k", "n"], spread(), SCHEMA))
    assert got == [("x", None, large, large, ""), (None, large, 5, 5, "a,b")]


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, v bigint, w string")
    assert ac.accumulate(df, ["k"], spread(), SCHEMA).count() == 0
