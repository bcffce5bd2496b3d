import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import lookups as lk


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "")], "id int, k string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("a", 2, "two"), ("a", 1, "one"), ("b", 3, None), (None, 4, "null")], "key string, n int, t string")


def test_lookup_one_never_multiplies(facts, dim):
    out = lk.lookup_one(facts, dim, {"k": "key"}, "d", ["t", "n"], ["n"])
    assert rows(out.select("id", "d.t", "d.n")) == [
        (1, "one", 1), (2, None, 3), (3, None, None), (4, None, None), (5, None, None),
    ]
    assert out.filter(F.col("d").isNull()).count() == 3


def test_lookup_many_gives_sorted_lists(facts, dim):
    out = lk.lookup_many(facts, dim, {"k": "key"}, "d", ["n"])
    got = {r.id: [x.n for x in r.d] for r in out.collect()}
    assert got == {1: [1, 2], 2: [3], 3: [], 4: [], 5: []}
    flat = lk.lookup_rows(facts, dim, {"k": "key"}, ["n"], "d_")
    assert rows(flat.select("id", "d_n")) == [(1, 1), (1, 2), (2, 3), (3, None), (4, None), (5, None)]


def test_lookup_on_several_conditions(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "a int, b string")
    other = spark.createDataFrame([(1, "x", 7)], "a int, b string, v int")
    assert rows(lk.lookup_one(df, other, ["a", "b"], "d", ["v"]).select("b", "d.v")) == [("x", 7), ("y", None)]


def test_mark_and_keep(facts, dim):
    assert rows(lk.mark_action(facts, dim, {"k": "key"}).select("id", "_op")) == [
        (1, "U"), (2, "U"), (3, "I"), (4, "I"), (5, "I"),
    ]
    assert rows(lk.keep_if_in(facts, dim, {"k": "key"}).select("id")) == [(1,), (2,)]
    assert rows(lk.keep_if_in(facts, dim, {"k": "key"}, negate=True).select("id")) == [(3,), (4,), (5,)]


def test_a_table_can_be_looked_up_in_itself(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 1)], "id int, parent int")
    assert rows(lk.keep_if_in(df, df, {"parent": "id"}).select("id")) == [(1,), (3,)]
    assert rows(lk.lookup_one(df, df, {"parent": "id"}, "p", ["id"]).select("id", "p.id")) == [(1, 2), (2, None), (3, 1)]


def test_decode_dim_falls_back_to_the_code(facts, dim):
    out = lk.decode_dim(facts, "k", dim, "t", "name", key="key")
    assert rows(out.select("id", "name")) == [(1, "one"), (2, "b"), (3, ""), (4, "z"), (5, "")]


def test_attach_embedding_rejects_records_without(spark, facts):
    emb = spark.createDataFrame([("a", [1.0]), ("a", [1.0]), ("q", [2.0])], "k string, embedding array<float>")
    ok, rejected = lk.attach_embedding(facts, emb, "k")
    assert rows(ok.select("id")) == [(1,)]
    assert rows(rejected.select("id")) == [(2,), (3,), (4,), (5,)]


def brute_force(number, ranges):
    hits = [(e - s, s, name) for s, e, name in ranges if s <= number <= e]
    return min(hits)[2] if hits else None


def dotted(n):
    return ".".join(str(n >> b & 255) for b in (24, 16, 8, 0))


def test_ip_regions_against_brute_force(spark):
    rng = random.Random(5)
    edges = sorted(rng.sample(range(2**32), 300) + [0, 2**32 - 1])
    ranges = [(a, b - 1 - rng.randrange(3), f"r{i}") for i, (a, b) in enumerate(zip(edges, edges[1:])) if i % 3 and b - a > 4]
    # Small ranges that share one group of addresses, and one that is a single address.
    base = 77 << 16
    ranges = [r for r in ranges if not (r[0] <= base + 65535 and r[1] >= base)]
    ranges += [(base + 10 * i, base + 10 * i + i % 10, f"s{i}") for i in range(50)]
    numbers = [rng.randrange(2**32) for _ in range(500)] + [base + i for i in range(600)]
    numbers += [e for r in ranges for e in (r[0], r[1], max(0, r[0] - 1), min(2**32 - 1, r[1] + 1))]
    texts = [dotted(n) for n in numbers] + ["bad", None, "::1||||"]
    df = spark.createDataFrame([(t if t is None or i % 2 else t + "||||",) for i, t in enumerate(texts)], "ip string")
    table = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, name string")
    wanted = {dotted(n): brute_force(n, ranges) for n in numbers}
    for disjoint in (True, False):
        out = lk.ip_region_join(df, "ip", table, ["name"], disjoint=disjoint).select("ip", "ipinfo.name").collect()
        assert len(out) == len(texts)
        for ip, name in out:
            assert name == wanted.get((ip or "").removesuffix("||||")), (ip, disjoint)


def test_nested_ranges_give_the_narrowest(spark):
    ranges = [(0, 2**32 - 1, "all"), (100, 5000, "outer"), (200, 300, "inner"), (250, 320, "across"), (70000, 70000, "one")]
    table = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, name string")
    numbers = [0, 99, 100, 199, 200, 249, 250, 256, 300, 301, 320, 5000, 5001, 69999, 70000, 70001, 2**32 - 1]
    df = spark.createDataFrame([(dotted(n), n) for n in numbers], "ip string, n bigint")
    got = lk.ip_region_join(df, "ip", table, ["name"], disjoint=False).select("n", "ipinfo.name").collect()
    assert dict(map(tuple, got)) == {n: brute_force(n, ranges) for n in numbers}
    with pytest.raises(Exception, match="overlap"):
        lk.ip_region_join(df, "ip", table, ["name"]).collect()


def test_blocks_cover_a_range_exactly(spark):
    rng = random.Random(9)
    ranges = [(0, 2**32 - 1), (5, 5), (2**32 - 1, 2**32 - 1)] + [tuple(sorted(rng.sample(range(2**32), 2))) for _ in range(40)]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "id int, s bigint, e bigint")
    found = {}
    for r in lk.range_blocks(table, "s", "e").collect():
        found.setdefault(r.id, []).append((r._value << (32 - r._len), 1 << (32 - r._len)))
    for i, (s, e) in enumerate(ranges):
        at = s
        for start, size in sorted(found[i]):
            assert start == at
            at += size
        assert at == e + 1 and len(found[i]) <= 62


def test_a_hot_key_is_split_over_tasks(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        df = spark.range(0, 200_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dim = spark.range(0, 200_000, 5).select(F.col("id").alias("key"), (F.col("id") + 1).alias("n"))
        out = lk.lookup_one(df, dim, {"k": "key"}, "d", ["n"])
        assert out.count() == 200_000
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert "skew=true" in plan


def test_attach_embedding_takes_the_first_vector_in_order(spark):
    emb = spark.createDataFrame([(1, 2, [1.0]), (1, 1, [5.0]), (2, 1, [3.0])], "k bigint, version int, embedding array<double>")
    ok, rejected = lk.attach_embedding(spark.range(1, 4).toDF("k"), emb, "k", order_cols=["version"])
    assert sorted((r.k, r.embedding) for r in ok.collect()) == [(1, [5.0]), (2, [3.0])]
    assert [r.k for r in rejected.collect()] == [3]


def test_mark_action_cuts_the_target_to_the_batch_first(spark):
    target = spark.range(1_000_000).withColumn("v", F.col("id") * 2)
    batch = spark.createDataFrame([(5,), (-1,), (None,)], "id bigint")
    marked = lk.mark_action(batch, target, "id")
    assert {(r.id, r._op) for r in marked.collect()} == {(5, "U"), (-1, "I"), (None, "I")}
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
