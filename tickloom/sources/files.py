"""Candle files and tick tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions import null_if_nan
from tickloom.schemas import PRICE_COLUMNS, TICK

CANDLE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICE_COLUMNS],
        T.StructField("volume", T.LongType()),
    ]
)


def read_candles(
    spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None
) -> DataFrame:
    """Candles from Parquet, JSON or CSV files, with a declared schema."""
    reader = spark.read.format(fmt).schema(CANDLE).options(**(options or {}))
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def with_sector(candles: DataFrame, universe: DataFrame) -> DataFrame:
    """Attach the sector of each listed ticker; unlisted tickers are left out."""
    return candles.join(universe, "ticker").select(
        "ticker",
        "sector",
        "timestamp",
        *[null_if_nan(F.col(name)).alias(name) for name in PRICE_COLUMNS],
        "volume",
    )


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """The tick table written by the stream (its day column prunes partitions)."""
    fields = [*TICK.fields, T.StructField("date_id", T.DateType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)
