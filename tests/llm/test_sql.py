"""Queries that SQL can express, against DuckDB over whole tables."""

import pytest
from oracle_compare import compare, connect

from orderloom.llm import queries, sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(sql.ALL))
def test_query(spark, duck, name):
    assert compare(duck, sql.ALL[name], queries.ALL[name](spark, SF)) is None


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.ALL]
    assert sorted(numbers) == list(range(1, 14))
