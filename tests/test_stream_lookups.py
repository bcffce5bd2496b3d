"""Versioned lookups and checked records, in one go and over streams."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.lookups import lookup_as_of
from tidemark.streaming import drain, file_stream, stream_checked, stream_counts, stream_lookup_as_of

RECORDS = "id bigint, k string, ts timestamp_ntz"
VERSIONS = "key string, since timestamp_ntz, v bigint"


def at(hours):
    return datetime(2024, 1, 1) + timedelta(hours=hours)


def brute(records, versions):
    out = []
    for i, k, ts in records:
        valid = [(since, v) for key, since, v in versions if key == k and k is not None and since is not None and ts is not None and since <= ts]
        out.append((i, max(valid)[1] if valid else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_s", [3600, 24 * 3600, 10**7])
def test_each_record_gets_the_version_of_its_time(spark, chunk_s):
    rng = random.Random(chunk_s)
    records = [(i, rng.choice(["hot"] * 5 + ["b", "c", None]), rng.choice([at(rng.randrange(-50, 200)), at(rng.randrange(200) / 7), None])) for i in range(300)]
    versions = [(rng.choice(["hot", "b", None]), rng.choice([at(rng.randrange(-20, 150)), None]), rng.randrange(1000)) for i in range(60)]
    df, dim = spark.createDataFrame(records, RECORDS), spark.createDataFrame(versions, VERSIONS)
    found = lookup_as_of(df, dim, {"k": "key"}, "ts", "since", "d", ["v"], chunk_s)
    assert found.columns == ["id", "k", "ts", "d"]
    assert rows(found.select("id", "d.v")) == brute(records, versions)
    assert rows(lookup_as_of(df, dim.limit(0), {"k": "key"}, "ts", "since", "d", ["v"]).select("id", "d.v")) == brute(records, [])
    assert lookup_as_of(df.limit(0), dim, {"k": "key"}, "ts", "since", "d", ["v"]).collect() == []


def test_records_after_a_change_get_the_new_version(spark, tmp_path):
    source, dim, out, checkpoint = (str(tmp_path / n) for n in ("in", "dim", "out", "ckpt"))
    batches = [[(1, "a", at(1)), (2, "a", at(5))], [(3, "a", at(2)), (4, "a", at(6)), (5, "b", at(6))]]
    changes = [[("a", at(0), 10)], [("a", at(4), 11), ("b", at(4), 20)]]
    for records, versions in zip(batches, changes, strict=True):
        spark.createDataFrame(records, RECORDS).coalesce(1).write.mode("append").parquet(source)
        spark.createDataFrame(versions, VERSIONS).coalesce(1).write.mode("append").parquet(dim)
        drain(stream_lookup_as_of(
            file_stream(spark, source, spark.read.parquet(source).schema), lambda: spark.read.parquet(dim),
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), checkpoint, {"k": "key"}, "ts", "since", "d", ["v"],
        ))
    assert rows(spark.read.parquet(out).select("id", "d.v")) == [(1, 10), (2, 10), (3, 10), (4, 11), (5, 20)]


def test_counts_add_up_over_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rules = [("small", F.col("id") < 3), ("null key", F.col("k").isNull())]

    def into(name):
        return lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={n}")

    def run(accept):
        stream = file_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
        query = stream_checked(stream, rules, accept, into("bad"), f"{out}/counts", checkpoint, F.col("k") == "skip", every=2)
        query.awaitTermination()

    def fail(batch, n):
        raise RuntimeError("target is away")

    for i in range(3):
        data = [(j, rng, at(j)) for j, rng in enumerate(["a", None, "skip", "a", "skip", None, "b"][: 5 + i])]
        spark.createDataFrame(data, RECORDS).coalesce(1).write.mode("append").parquet(source)
        if i == 1:
            with pytest.raises(Exception, match="target is away"):
                run(fail)
        run(into("good"))
    total = stream_counts(spark, f"{out}/counts").first()
    good, bad = (spark.read.parquet(f"{out}/{n}") for n in ("good", "bad"))
    assert total.total == 18 == total.success + total.failed + total.ignored
    assert (total.success, total.failed) == (good.count(), bad.count())
    assert rows(bad.groupBy("reject_reason").count()) == [("null key", 2), ("small", 9)]
