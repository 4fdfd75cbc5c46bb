"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks import compare, oracle, registry
from tests.conftest import SMALL

QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = compare.duck(SMALL)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) >= 44
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SMALL), duck.sql(SQL[name])
    assert compare.type_differences(dict(ours.dtypes), theirs) == []
    assert compare.differences(ours.toPandas(), theirs.df()) == []


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.volume_rank for r in sorted(rows, key=lambda r: r.volume_rank)][0] == 1
