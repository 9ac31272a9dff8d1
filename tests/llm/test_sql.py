"""Operators whose result SQL can express, against DuckDB."""

import pytest

import compare
from tickloom.llm.oracles import ORACLES
from tickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), ORACLES[name], compare.duck(FOLDER)) == ""
