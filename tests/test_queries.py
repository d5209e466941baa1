"""Every named query against its SQL twin."""

import pytest
from compare import connect, differences
from conftest import DATA

import __spark_entry__ as entry

QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, TWINS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_flagship(spark):
    got = entry.entry(spark).agg({"correct": "sum", "total": "sum"}).first()
    assert (got["sum(total)"], got["sum(correct)"]) == (200, 120)


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)
