"""Questions users ask of the models: today's leaders, look-ups, rates, freshness."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.asof import AsOf
from tickloom.functions import market_is_open, seconds_between
from tickloom.operators import folders
from tickloom.operators.rank import top_within
from tickloom.sources.files import read_ticks

# Age limits in seconds of the daily gate and of the alarm.
GATE_SECONDS = 600
ALARM_SECONDS = 900


def top5_today(top5: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    """Today's leaders, rounded for display."""
    return (
        top5.filter(F.col("date_id") == as_of.today)
        .select(
            "sector",
            "date_id",
            "ticker",
            "volume_rank",
            F.round("close_price", 0).alias("close_price"),
            F.round(F.col("price_change_pct") * 100, 2).alias("change_pct"),
            "total_volume",
        )
        .orderBy("sector", "volume_rank")
    )


def top_gainers(daily: DataFrame, as_of: AsOf = AsOf(), n: int = 10) -> DataFrame:
    return (
        daily.filter(F.col("date_id") == as_of.today)
        .select("ticker", "sector", "price_change_pct", "total_volume")
        .orderBy(F.col("price_change_pct").desc_nulls_last(), "ticker", "sector")
        .limit(n)
    )


def ticker_day(ticks: DataFrame, ticker: str, day: str, n: int = 5) -> DataFrame:
    """Latest ``n`` ticks of one ticker on one day."""
    return (
        ticks.filter((F.col("ticker") == ticker) & (F.to_date("timestamp") == F.lit(day).cast("date")))
        .orderBy(F.col("timestamp").desc())
        .limit(n)
    )


def latest_ticks_per_day(ticks: DataFrame, n: int = 5) -> DataFrame:
    """The same for every ticker and day at once."""
    dated = ticks.withColumn("date_id", F.to_date("timestamp"))
    order = [F.col("timestamp").desc()]
    return top_within(dated, n, "recency_rank", ["ticker", "date_id"], order)


def sector_leaderboard(summary: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    return (
        summary.filter(F.col("date_id") == as_of.today)
        .orderBy("sector_performance_rank")
        .select("sector", "avg_price_change_pct", "tickers_up", "tickers_down")
    )


def active_tickers(tickers: DataFrame) -> DataFrame:
    return tickers.filter("is_active").orderBy("sector", "ticker_code")


def sectors_by_category(sectors: DataFrame) -> DataFrame:
    return sectors.orderBy("sector_category", "sector_name")


def star_of_day(
    fact: DataFrame, tickers: DataFrame, sectors: DataFrame, as_of: AsOf = AsOf()
) -> DataFrame:
    """Today's fact rows with names, most traded first.

    The day filter leaves little of the fact, so the join strategy is left to
    adaptive execution.
    """
    return (
        fact.filter(F.to_date("timestamp") == as_of.today)
        .join(tickers.select("ticker_sk", "ticker_name"), "ticker_sk")
        .join(sectors.select("sector_sk", "sector_name"), "sector_sk")
        .select("ticker_name", "sector_name", "close", "volume")
        .orderBy(F.col("volume").desc_nulls_last())
    )


def breadth_of_day(breadth: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    return breadth.filter(F.col("date_id") == as_of.today)


def ticks_per_ticker(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker").agg(F.count(F.lit(1)).alias("tick_count"))


def ticks_per_minute(ticks: DataFrame) -> DataFrame:
    """Messages per fetch minute and their rate per second."""
    counted = ticks.groupBy(F.window("fetch_ts", "1 minute")).agg(
        F.count(F.lit(1)).alias("tick_count")
    )
    return counted.select(
        F.col("window.start").alias("minute_start"),
        "tick_count",
        (F.col("tick_count") / 60.0).alias("rate_per_second"),
    )


def recent_hour(ticks: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    return ticks.filter(F.col("timestamp") > as_of.hours_before_now(1)).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("timestamp").alias("latest_ts")
    )


def table_size(ticks: DataFrame) -> DataFrame:
    return ticks.agg(F.count(F.lit(1)).alias("row_count"))


def recent_part(
    read: Callable[[str | None], DataFrame], as_of: AsOf = AsOf(), days: Sequence[int] = (1, 30)
) -> DataFrame:
    """The shortest stretch of history before ``as_of`` that holds its newest tick.

    ``read(since)`` gives the ticks from an instant on and prunes by it. A day is looked at
    first, more only if it is empty, so the newest tick costs no scan of the history.
    """
    spark = SparkSession.active()
    for count in days:
        since = str(spark.range(1).select(as_of.days_before_now(count).cast("timestamp_ntz")).first()[0])
        part = read(since)
        inside = F.col("timestamp").between(F.lit(since).cast("timestamp"), as_of.now)
        if not part.filter(inside).isEmpty():
            return part
    return read(None)


def newest_day(spark: SparkSession, path: str, as_of: AsOf = AsOf()) -> DataFrame:
    """Rows of the last day folder of a stored tick table up to today: folder names tell which
    one it is, and no other folder is opened."""
    today = str(spark.range(1).select(as_of.today).first()[0])
    stored = [name.partition("=")[2] for name in folders.names(spark, path) if name.startswith("date_id=")]
    past = [day for day in stored if day <= today]
    ticks = read_ticks(spark, path)
    return ticks.filter(F.col("date_id") == F.lit(max(past)).cast("date")) if past else ticks.limit(0)


def freshness(ticks: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    """Age of the newest tick, the daily gate (today only) and the alarm."""
    seen = ticks.filter(F.col("timestamp") <= as_of.now)
    today = F.to_date("timestamp") == as_of.today
    newest = seen.agg(
        F.max("timestamp").alias("latest_ts"),
        F.max(F.when(today, F.col("timestamp"))).alias("latest_today_ts"),
    )
    age = seconds_between(F.col("latest_ts"), as_of.now)
    age_today = seconds_between(F.col("latest_today_ts"), as_of.now)
    return newest.select(
        "latest_ts",
        age.alias("age_seconds"),
        F.coalesce(age_today < GATE_SECONDS, F.lit(False)).alias("gate_open"),
        F.coalesce(age > ALARM_SECONDS, F.lit(False)).alias("too_old"),
    )


def market_hours(ticks: DataFrame) -> DataFrame:
    return ticks.select(
        "ticker", "timestamp", market_is_open(F.col("timestamp")).alias("is_market_open")
    )
