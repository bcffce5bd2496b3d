"""Searches over the index against the whole table, and how little of it they read."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.vector_index import VectorIndex
from tidemark.operators.vectors import vector_range, vector_topk

SCHEMA = "id bigint, v array<float>, kind int"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    data = [(i, (centres[i % 20] * rng.uniform(0.5, 2) + rng.normal(size=16) * 0.05).astype(float).tolist(), i % 3) for i in range(3000)]
    data += [(4000, None, 0), (4001, [], 0), (4002, [0.0] * 16, 0), (4003, [1.0, 2.0], 0), (4004, [float("nan")] * 16, 0)]
    data += [(5000 + i, data[7][1], 1) for i in range(50)]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    return VectorIndex.build(table, "id", "v", str(tmp_path_factory.mktemp("index") / "v"), pivots=32, sample_rows=500)


def files(df):
    return df.select(F.input_file_name()).distinct().count()


@pytest.mark.parametrize("radius", [0.99, 0.9, 0.3, -1.0])
def test_all_rows_within_a_radius(spark, table, index, radius):
    query = [float(x) for x in table.where("id = 7").first()["v"]]
    whole = vector_range(table, "v", query, radius, "kind <> 2", ["id"])
    assert rows(index.range(query, radius, "kind <> 2", ["id"])) == rows(whole)


def test_the_best_rows_with_ties(spark, table, index):
    for at in (7, 11, 2500):
        query = [float(x) + 0.01 for x in table.where(f"id = {at}").first()["v"]]
        for k in (1, 20, 400):
            whole = vector_topk(table, "v", query, k, "id", "kind <> 0", ["id"])
            assert [tuple(r) for r in index.topk(query, k, "id", "kind <> 0", ["id"]).collect()] == [tuple(r) for r in whole.collect()]
    # More than there are, and a query in no direction of the table.
    assert index.topk(query, 5000, "id").count() == 3050
    assert index.topk([1.0] * 16, 3, "id").count() == 3
    assert index.range([1.0, 2.0], 0.5).count() == 0


def test_few_files_are_read_for_clustered_vectors(spark, table, index):
    query = [float(x) for x in table.where("id = 7").first()["v"]]
    assert files(index.near(query, 0.95)) < 0.25 * files(index._stored())
    assert index._stored().count() == table.count()


def test_an_empty_table(spark, table, tmp_path):
    index = VectorIndex.build(table.limit(0), "id", "v", str(tmp_path / "v"))
    assert index.range([1.0] * 16, 0.1).collect() == [] and index.topk([1.0] * 16, 3, "id").collect() == []
