"""Every query against its SQL, over whole tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry_points
from orderloom.contract import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries.ALL) == set(oracle.ALL)


def test_every_query_is_registered():
    assert set(queries.ALL) <= set(entry_points.queries())
    assert set(oracle.ALL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query(spark, duck, name):
    assert compare(duck, oracle.ALL[name], queries.ALL[name](spark, SF)) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500
