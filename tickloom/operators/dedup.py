"""Batch de-duplication: first of a key, and the running high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.operators.rank import top_within

# One window group of the high-water mark covers 2**GROUP_BITS rows (or buckets).
GROUP_BITS = 12
LEVELS = 2


def first_per_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """Keep the first row of each key; copies are dropped before the shuffle."""
    order: list[Column] = [F.col(c).asc() for c in order_by]
    return top_within(df, 1, "_first", key, order).drop("_first")


def highest_so_far(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    name: str,
    bits: int = GROUP_BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """Add the maximum of ``value`` over the key's earlier rows (by integer ``order``).

    One window per key would put a hot key into one task. Instead the order axis is
    cut into buckets: a window per (key, bucket) covers the rows inside, and the
    maxima of whole earlier buckets come from the same operator applied to one row
    per bucket. Rows are shuffled once, on (key, bucket); each level shrinks the
    largest group by ``2**bits``.
    """
    if levels == 0:
        whole = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(name, F.max(value).over(whole))

    bucket, top, earlier = f"_bucket{levels}", f"_top{levels}", f"_earlier{levels}"
    bucketed = df.withColumn(bucket, F.shiftright(F.col(order).cast("bigint"), bits))
    per_bucket = bucketed.groupBy(key, bucket).agg(F.max(value).alias(top))
    marks = highest_so_far(per_bucket, key, bucket, top, earlier, bits, levels - 1).select(
        key, bucket, earlier
    )
    # Every bucket has its marks. A left join, because an inner one would add a filter to
    # this side only, and the two uses of ``per_bucket`` would no longer share a shuffle.
    inside = W.partitionBy(key, bucket).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        bucketed.join(marks, [key, bucket], "left")
        .withColumn(name, F.greatest(earlier, F.max(value).over(inside)))
        .drop(bucket, earlier)
    )


def rising_only(
    df: DataFrame,
    key: str,
    order: str,
    time: str,
    known: DataFrame | None = None,
    bits: int = GROUP_BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """Keep a row only if it is later than every earlier-arrived row of its key.

    ``known`` optionally holds the marks reached before this data, as
    (key, high_water). Late originals are dropped as well as repeats; that is the
    rule of the feed. Rows without a time, key or order cannot be compared and are
    dropped.
    """
    rows = df.filter(
        F.col(time).isNotNull() & F.col(key).isNotNull() & F.col(order).isNotNull()
    )
    if known is not None:
        rows = newer_than(rows, known, key, time)
    marked = highest_so_far(rows, key, order, time, "_mark", bits, levels)
    return marked.filter(F.col("_mark").isNull() | (F.col(time) > F.col("_mark"))).drop("_mark")


def high_water(df: DataFrame, key: str = "ticker", time: str = "timestamp") -> DataFrame:
    """Latest time per key: the state the next run compares with."""
    return df.groupBy(key).agg(F.max(time).alias("high_water"))


def newer_than(
    df: DataFrame, known: DataFrame, key: str = "ticker", time: str = "timestamp"
) -> DataFrame:
    """Rows later than the known mark of their key; keys without a mark pass.

    ``known`` has one row per key, so a hot key only repeats its single mark when
    adaptive execution splits it.
    """
    marks = known.select(key, "high_water")
    return (
        df.join(marks, key, "left")
        .filter(F.col("high_water").isNull() | (F.col(time) > F.col("high_water")))
        .select(*df.columns)
    )
