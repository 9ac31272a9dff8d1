"""Do two layers hold the same rows, and do facts and dimensions know each other?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def fingerprint(df: DataFrame, columns: Sequence[str], day: Column, row_hash: Column | None = None) -> DataFrame:
    """``date_id, row_count, hash_sum, hash_xor`` per day, in one pass with map-side combine.

    The parts add up in any order: fingerprints of pieces merge into that of the whole. The sum
    tells apart what a repeated row cancels in the xor. Only ``columns`` are read.
    """
    value = F.xxhash64(*columns) if row_hash is None else row_hash
    return df.groupBy(day.alias("date_id")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(value.cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor(value).alias("hash_xor"),
    )


def differing_days(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days whose fingerprints differ, or that only one side has: days are compared, not rows."""
    parts = ["row_count", "hash_sum", "hash_xor"]
    one = left.select("date_id", F.struct(*parts).alias("left"))
    two = right.select("date_id", F.struct(*parts).alias("right"))
    both = one.join(two, "date_id", "full")
    return both.filter(~F.col("left").eqNullSafe(F.col("right"))).select(
        "date_id", F.col("left.row_count").alias("left_rows"), F.col("right.row_count").alias("right_rows")
    )


def key_integrity(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: fact rows without a key, fact rows and keys unknown to the dimension, dimension
    rows without a fact. The fact is counted per key before it meets the dimension."""
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    known = dimension.select(F.col(key), F.lit(1).alias("_known"))
    both = used.join(known, key, "full")
    orphan = F.col(key).isNotNull() & F.col("_known").isNull()
    return both.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_rows"))), F.lit(0)).alias("rows_without_key"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("rows_with_unknown_key"),
        F.count_if(orphan).alias("unknown_keys"),
        F.count_if(F.col("_rows").isNull()).alias("unused_dimension_rows"),
    )
