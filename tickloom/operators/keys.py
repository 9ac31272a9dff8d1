"""Consecutive row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.joins import broadcast_within
from tickloom.session import cut_lineage

# monotonically_increasing_id(): partition number above, row position below bit 33.
POSITION_BITS = 33


def number_rows(df: DataFrame, name: str, order_by: list[Column]) -> tuple[DataFrame, int]:
    """Number the rows 1..n in the given order; returns the frame and n.

    ``row_number()`` over a global order moves every row into one task. Here the rows
    are range-partitioned and sorted, checkpointed so that the ranges cannot move,
    and numbered as (rows in earlier partitions) + (position in the partition). Only
    the row count of each partition comes to the driver.
    """
    ranged = cut_lineage(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by))
    counts = ranged.groupBy(F.spark_partition_id().alias("part")).count().collect()
    sizes = [0] * (1 + max((row["part"] for row in counts), default=0))
    for row in counts:
        sizes[row["part"]] = row["count"]
    starts = ", ".join(f"{start}L" for start in accumulate(sizes, initial=1))

    placed = ranged.withColumn("_mono", F.monotonically_increasing_id())
    part = f"CAST(shiftright(_mono, {POSITION_BITS}) AS INT)"
    position = f"(_mono & {(1 << POSITION_BITS) - 1}L)"
    number = F.expr(f"array({starts})[{part}] + {position}").alias(name)
    return placed.select(number, *df.columns), sum(sizes)


def with_surrogate_key(df: DataFrame, name: str, order_by: list[str]) -> DataFrame:
    """Keys 1..n in the order of the columns (NULL first).

    The counted total decides whether joins may broadcast the result.
    """
    keyed, rows = number_rows(df, name, [F.col(c).asc_nulls_first() for c in order_by])
    return broadcast_within(keyed, rows)


def same_values(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Join condition: all columns equal, NULL with NULL."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def extend_keys(known: DataFrame | None, values: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """The key registry ``name, *columns`` with every distinct row of ``values`` in it.

    Keys once given are kept. New values are numbered above the largest key, in the order of
    the columns (NULL first), over range partitions.
    """
    fresh = values.select(*columns).distinct()
    start = 0
    if known is not None:
        fresh = fresh.join(known, same_values(fresh, known, columns), "left_anti")
        start = known.agg(F.max(name)).first()[0] or 0
    numbered, _ = number_rows(fresh, "_number", [F.col(c).asc_nulls_first() for c in columns])
    added = numbered.select((F.col("_number") + start).cast("bigint").alias(name), *columns)
    return added if known is None else known.select(name, *columns).unionByName(added)
