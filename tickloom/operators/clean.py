"""Row-level cleaning; narrow transformations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import null_if_nan, parse_iso
from tickloom.schemas import PRICE_COLUMNS


def drop_bad_keys(df: DataFrame, column: str = "ticker") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def nan_to_null(df: DataFrame, columns: tuple[str, ...] = PRICE_COLUMNS) -> DataFrame:
    """NaN to NULL. Spark orders NaN above every number, so this comes before MAX."""
    return df.withColumns({name: null_if_nan(F.col(name)) for name in columns})


def type_times(df: DataFrame, columns: tuple[str, ...] = ("timestamp", "fetch_ts")) -> DataFrame:
    return df.withColumns({name: parse_iso(F.col(name)) for name in columns})


def clean_ticks(records: DataFrame) -> DataFrame:
    """Parsed records to typed ticks: keys present, NaN gone, times as instants."""
    return type_times(nan_to_null(drop_bad_keys(records)))
