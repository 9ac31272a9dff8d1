"""Coverage of every trading day, also of days without a single tick."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def trading_days(spark: SparkSession, first: str, last: str, holidays: tuple[str, ...] = ()) -> DataFrame:
    """``date_id`` from Monday to Friday, without the holidays."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_id"))
    return days.filter((F.weekday("date_id") < 5) & ~F.col("date_id").cast("string").isin(list(holidays)))


def listed_days(listing: DataFrame, days: DataFrame) -> DataFrame:
    """``date_id, ticker, sector`` for every trading day on which a ticker is listed.

    ``listing`` has ``valid_from`` and ``valid_to`` (NULL: still listed), as the type-2 history
    of tickers. Periods are unfolded and met with the calendar by equality, so the size is that
    of the result; nothing is compared with everything.
    """
    last = F.lit(days.agg(F.max("date_id")).first()[0]).cast("date")
    until = F.least(F.coalesce("valid_to", last), last)
    unfolded = listing.filter(F.col("valid_from") <= until).select(
        F.explode(F.sequence("valid_from", until)).alias("date_id"), "ticker", "sector"
    )
    return unfolded.join(days, "date_id", "left_semi")


def _seen(ticks: DataFrame) -> DataFrame:
    return ticks.select(F.to_date("timestamp").alias("date_id"), "ticker").distinct()


def missing_by_day(ticks: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of ``listed_days`` without a tick."""
    return expected.join(_seen(ticks), ["date_id", "ticker"], "left_anti")


def coverage_by_day(ticks: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected, succeeded and failed tickers of each trading day, all failed included."""
    seen = _seen(ticks).withColumn("_seen", F.lit(1))
    joined = expected.join(seen, ["date_id", "ticker"], "left")
    return joined.groupBy("date_id").agg(
        F.count(F.lit(1)).alias("tickers_expected"),
        F.count("_seen").alias("tickers_succeeded"),
        F.count_if(F.col("_seen").isNull()).alias("tickers_failed"),
    )
