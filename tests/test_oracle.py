"""Every registered query against its SQL twin, over the whole tables."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(request):
    return connect("/root/testdata/sf0.001")


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns[:3] == ["metric_type", "metric", "data_time"]
    assert df.count() > 0


def test_only_training_data_queries_have_no_twin():
    """Those are held against brute force in their own folder."""
    without = set(queries()) - set(oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in without)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert differences(spark, con, queries()[name], oracle_sql()[name], sf_dir) is None
