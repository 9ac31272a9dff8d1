"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
import compare
from conftest import DATA

# Queries of the optional subpackage are tested beside it.
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def connection():
    return compare.duck(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, DATA), ORACLES[name], connection) == ""


def test_flagship_returns_rows(spark):
    assert len(entry.entry(spark).take(1)) == 1
