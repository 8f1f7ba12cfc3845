"""Every query against its SQL, on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry
from assaylake import queries as own
from tests.compare import connect, differences

WITHOUT_SQL = {"X1_rf_cells"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(own.SQL))
def test_query_matches_its_sql(spark, con, sf, name):
    assert differences(spark, con, name, own.QUERIES[name], own.SQL[name], sf) == ""


def test_queries_without_sql_are_known(spark, sf):
    assert set(own.QUERIES) - set(own.SQL) == WITHOUT_SQL
    for name in WITHOUT_SQL:
        assert own.QUERIES[name](spark, sf).count() > 0
    for name in ("A13_welch_p_value", "A23_ranksum_p_value"):
        assert all(r["p"] is None or math.isnan(r["p"]) or 0 <= r["p"] <= 1 for r in own.QUERIES[name](spark, sf).collect())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
