"""Every registered query against its SQL counterpart."""

import compare
import pytest

import __spark_entry__ as entry_points
from tracelark.plans import catalogue, oracle

QUERIES = catalogue.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_points_hold_every_query():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, connection, name):
    _, extra, missing = compare.differences(QUERIES[name](spark, folder), connection, SQL[name])
    assert not extra and not missing, (extra[:3], missing[:3])
