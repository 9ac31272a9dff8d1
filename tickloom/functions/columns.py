"""JVM-side column expressions; none of them needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wire format of times, the exchange's offset, its session and suffix.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
MARKET_OFFSET = "+07:00"
MARKET_OPEN_MINUTE = 9 * 60
MARKET_CLOSE_MINUTE = 15 * 60
TICKER_SUFFIX = ".JK"

# Sector groups; every other sector falls into DEFAULT_CATEGORY.
SECTOR_GROUPS = {
    "Financial": ["Financials", "Properties & Real Estate"],
    "Infrastructure & Tech": ["Technology", "Infrastructures", "Transportation & Logistic"],
    "Commodities": ["Energy", "Basic Materials"],
}
DEFAULT_CATEGORY = "Consumer & Services"


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text with offset to an instant; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(ISO_FORMAT))


def iso_offset_string(instant: Column) -> Column:
    """Instant to ISO-8601 text at the exchange's offset, whole seconds."""
    local = F.from_utc_timestamp(instant, MARKET_OFFSET)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(MARKET_OFFSET))


def to_utc_instant(value: Column) -> Column:
    """Zone-less time read as UTC (the session zone is UTC)."""
    return value.cast("timestamp")


def market_is_open(instant: Column) -> Column:
    """True on weekdays from 09:00 until before 15:00 at the exchange's offset."""
    local = F.from_utc_timestamp(instant, MARKET_OFFSET)
    minute = F.hour(local) * 60 + F.minute(local)
    return (
        (F.weekday(local) < 5)
        & (minute >= MARKET_OPEN_MINUTE)
        & (minute < MARKET_CLOSE_MINUTE)
    )


def display_name(ticker: Column) -> Column:
    return F.initcap(F.replace(ticker, F.lit(TICKER_SUFFIX), F.lit("")))


def sector_category(sector: Column) -> Column:
    category = F.lit(DEFAULT_CATEGORY)
    for name, members in SECTOR_GROUPS.items():
        category = F.when(sector.isin(members), name).otherwise(category)
    return category


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)
