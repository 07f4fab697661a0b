"""Every query with SQL must equal it; the others must give rows."""

import pytest

from compare import differences, open_duckdb
from __spark_entry__ import entry, oracle_sql, queries

QUICK_ROWS = ["distinct_counts_approx", "box_stats_approx", "bernoulli_sample", "pca2"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_duckdb(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", QUICK_ROWS)
def test_query_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["region", "extreme", "n"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
