"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB type of the published columns.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(result, sql: str, connection) -> str:
    """Empty when equal, else a short description."""
    relation = connection.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {name: TYPES.get(kind, kind) for name, kind in result.dtypes}
    if expected_types != actual_types:
        mine = set(actual_types.items()) - set(expected_types.items())
        theirs = set(expected_types.items()) - set(actual_types.items())
        return f"schema: spark {sorted(mine)} sql {sorted(theirs)}"
    expected = _bag(relation.columns, relation.fetchall())
    actual = _bag(result.columns, [tuple(row) for row in result.collect()])
    if expected == actual:
        return ""
    missing, extra = expected - actual, actual - expected
    return (
        f"rows spark {sum(actual.values())} sql {sum(expected.values())}; "
        f"missing {sum(missing.values())} e.g. {list(missing)[:1]}; "
        f"extra {sum(extra.values())} e.g. {list(extra)[:1]}"
    )
