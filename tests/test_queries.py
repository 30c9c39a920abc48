"""Every named query against its SQL in DuckDB, and the driver contract."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle_check import connect, differences
from vidpulse.plans.oracle import ORACLE_SQL
from vidpulse.plans.registry import QUERIES

@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(spark, name, sf_dir, con) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) >= set(QUERIES)


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert "hot_label" in df.columns and df.count() > 0
