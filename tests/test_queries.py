"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from caudal.workload.registry import QUERIES, SQL
from compare import connect, difference


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    message, _, _ = difference(con, spark, sf, QUERIES[name], SQL.get(name))
    assert message is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark, sf):
    frame = entry.entry(spark)
    assert "CHILD_ID" in frame.columns and frame.count() > 0
