"""Every query with a SQL twin, Spark against DuckDB on the smallest driver tables; the rest must
run and return rows."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
