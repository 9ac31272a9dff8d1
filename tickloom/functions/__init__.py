"""Column expressions shared by the operators and plans."""

from tickloom.functions.columns import (
    TICKER_SUFFIX,
    display_name,
    iso_offset_string,
    market_is_open,
    null_if_nan,
    parse_iso,
    safe_ratio,
    sector_category,
    seconds_between,
    to_utc_instant,
)

__all__ = [
    "TICKER_SUFFIX",
    "display_name",
    "iso_offset_string",
    "market_is_open",
    "null_if_nan",
    "parse_iso",
    "safe_ratio",
    "sector_category",
    "seconds_between",
    "to_utc_instant",
]
