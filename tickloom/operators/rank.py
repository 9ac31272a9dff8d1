"""Ranks with a full ordering, so that ties cannot move between runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.operators.keys import number_rows


def with_row_number(
    df: DataFrame, name: str, partition_by: list[str], order_by: list[Column]
) -> DataFrame:
    """Number the rows of each group in one window; for groups of bounded size."""
    window = W.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def top_within(
    df: DataFrame, n: int, name: str, partition_by: list[str], order_by: list[Column]
) -> DataFrame:
    """First ``n`` rows of each group, numbered.

    The filter sits directly on the row number, so Spark keeps at most ``n`` rows
    per group and task before the shuffle: a group holding a third of the table
    costs no more than any other.
    """
    window = W.partitionBy(*partition_by).orderBy(*order_by)
    return (
        df.withColumn(name, F.row_number().over(window))
        .filter(F.col(name) <= n)
        .withColumn(name, F.col(name).cast("bigint"))
    )


def with_rank_in_large_groups(
    df: DataFrame, name: str, partition_by: list[str], order_by: list[Column]
) -> DataFrame:
    """The same numbers where one group may hold much of the table.

    All rows are numbered in (group, order) sequence by ranges; a row's rank is its
    distance from the first row of its group. No task sees a whole group.
    """
    groups = [F.col(c).asc_nulls_first() for c in partition_by]
    numbered, _ = number_rows(df, "_row", [*groups, *order_by])
    first = numbered.groupBy(*[F.col(c).alias(f"_of_{c}") for c in partition_by]).agg(
        F.min("_row").alias("_first_row")
    )
    same_group = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in partition_by]
    )
    rank = (F.col("_row") - F.col("_first_row") + 1).alias(name)
    return numbered.join(first, same_group).select(*df.columns, rank)
