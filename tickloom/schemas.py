"""Record contracts, table schemas and the rules for changing them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Field names, order and types of the tick record, version 1.
TICK_JSON_V1 = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("fetch_ts", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)
REQUIRED_FIELDS = ("ticker", "sector", "timestamp", "fetch_ts")
SCHEMA_NAME = "stock_tick"
SCHEMA_VERSION = "1"

PRICE_COLUMNS = ("open", "high", "low", "close")
TICK_COLUMNS = tuple(TICK_JSON_V1.names)

# The warehouse tick table: the record with its two times as instants.
TICK = T.StructType(
    [
        T.StructField(
            f.name,
            T.TimestampType() if f.name in ("timestamp", "fetch_ts") else f.dataType,
        )
        for f in TICK_JSON_V1.fields
    ]
)

# The quality log, one row per check and run.
DQ_RESULT = T.StructType(
    [
        T.StructField("check_id", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("execution_ts", T.TimestampType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("failure_rate", T.DoubleType()),
        T.StructField("details", T.StringType()),
        T.StructField("severity", T.StringType()),
    ]
)


def contract_changes(
    old: T.StructType, new: T.StructType, required: tuple[str, ...] = REQUIRED_FIELDS
) -> list[tuple[str, str, bool]]:
    """Changes from ``old`` to ``new`` as (field, change, allowed).

    New fields must be nullable; removing, retyping or requiring a field is refused.
    """
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    changes = [(name, "removed", False) for name in before if name not in after]
    for name, field in after.items():
        if name not in before:
            changes.append((name, "added", field.nullable and name not in required))
        elif before[name].dataType != field.dataType:
            changes.append((name, "retyped", False))
        elif before[name].nullable and not field.nullable:
            changes.append((name, "made required", False))
    return changes


def is_compatible(old: T.StructType, new: T.StructType) -> bool:
    return all(allowed for _, _, allowed in contract_changes(old, new))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order; missing ones become typed NULLs."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_versions(*frames: DataFrame) -> DataFrame:
    """Union frames written under different contract versions, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_versions(spark: SparkSession, paths: dict[str, T.StructType], schema: T.StructType) -> DataFrame:
    """Parquet files written under several contract versions as one frame of ``schema``; a field
    that files of an older version lack is NULL."""
    return union_versions(*[conform(spark.read.schema(own).parquet(path), schema) for path, own in paths.items()])
