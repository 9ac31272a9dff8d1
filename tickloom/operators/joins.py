"""Joins to dimensions whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rows of (code, key) that may be sent to every executor: tens of megabytes.
BROADCAST_ROWS = 500_000


def broadcast_within(df: DataFrame, rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``df``, counted by the caller to hold ``rows``, is small.

    Above the bound the frame is returned as it is: the join then shuffles, and
    adaptive execution splits its skewed partitions. The hint survives projections.
    """
    return F.broadcast(df) if rows <= max_rows else df


def lookup_key(df: DataFrame, dimension: DataFrame, on: Column) -> DataFrame:
    """Left join to the (already narrowed) dimension, keeping unmatched rows.

    The size decides the strategy: freshly keyed dimensions carry a hint if they were
    counted to be small, stored ones are judged by Spark from their files.
    """
    return df.join(dimension, on, "left")
