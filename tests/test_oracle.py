"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import DATA

import __spark_entry__ as contract
from tallymart.checks.oracle import all_sql
from tallymart.checks.registry import all_queries
from tallymart.plans.silver import FLAGS

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, DATA), duck, SQL[name]) == []


@pytest.mark.parametrize("entity", sorted(FLAGS))
def test_the_fixture_reaches_every_rule(duck, entity):
    """Each flag is set on some row, so that the comparison says something about it."""
    found = duck.execute(SQL[f"layers_verify_{entity}"]).df().iloc[0]
    assert [flag for flag in FLAGS[entity] if found[flag] == 0] == []
