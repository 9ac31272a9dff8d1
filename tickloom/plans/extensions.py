"""Models from the design notes: hourly roll-ups, trends, history, rolling scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.asof import AsOf
from tickloom.functions import safe_ratio
from tickloom.operators.rank import top_within, with_rank_in_large_groups
from tickloom.plans.models import FLAT_CHANGE, TOP_N, candle_stats

AGG_DAYS = 7


def _day_number(day: str = "date_id") -> Column:
    return F.unix_date(F.col(day))


def daily_ticker_stats(fact: DataFrame, as_of: AsOf = AsOf(), days: int = AGG_DAYS) -> DataFrame:
    """Daily candles per ticker key."""
    recent = fact.filter(F.col("timestamp") >= as_of.days_before_now(days)).withColumn(
        "date_id", F.to_date("timestamp")
    )
    stats = candle_stats(recent, ["ticker_sk", "sector_sk", "date_id"])
    return stats.drop("first_tick_ts", "last_tick_ts", "tick_count")


def _by_volume() -> list[Column]:
    return [F.col("total_volume").desc_nulls_last(), F.col("ticker_sk").asc()]


def daily_ticker_aggregate(stats: DataFrame) -> DataFrame:
    """Every ticker's volume rank within its sector-day."""
    return with_rank_in_large_groups(
        stats, "volume_rank_in_sector", ["sector_sk", "date_id"], _by_volume()
    )


def sector_hourly(staged: DataFrame) -> DataFrame:
    """Hourly candles per ticker, rolled up to the sector-hour."""
    hourly = candle_stats(staged, ["ticker", "sector", "hour_bucket"])
    change = F.col("price_change_pct")
    return hourly.groupBy("sector", "hour_bucket").agg(
        F.avg(change).alias("avg_price_change_pct"),
        F.sum("total_volume").alias("total_volume"),
        F.count_if(change > 0).alias("tickers_up"),
        F.count_if(change < 0).alias("tickers_down"),
        F.count_if(F.abs(change) < FLAT_CHANGE).alias("tickers_flat"),
    )


def top5_view(
    stats: DataFrame, tickers: DataFrame, sectors: DataFrame, as_of: AsOf = AsOf()
) -> DataFrame:
    """Today's most traded tickers by name; five rows per sector reach the joins."""
    today = stats.filter(F.col("date_id") == as_of.today)
    top = top_within(
        today, TOP_N, "volume_rank_in_sector", ["sector_sk", "date_id"], _by_volume()
    )
    return (
        top.join(tickers.select("ticker_sk", "ticker_code"), "ticker_sk")
        .join(sectors.select("sector_sk", "sector_name"), "sector_sk")
        .select("sector_name", "ticker_code", "total_volume", "volume_rank_in_sector")
    )


def market_summary(stats: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    change = F.col("price_change_pct")
    return stats.filter(F.col("date_id") == as_of.today).agg(
        F.count_distinct("ticker_sk").alias("total_tickers"),
        F.avg(change).alias("avg_market_change"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.sum("total_volume").alias("total_market_volume"),
    )


def gainers_and_losers(daily: DataFrame) -> DataFrame:
    """Best and worst ticker of each sector-day; equal changes go by ticker order."""
    change = F.col("price_change_pct")
    best = F.when(change.isNotNull(), F.struct((-change).alias("c"), "ticker"))
    worst = F.when(change.isNotNull(), F.struct(change.alias("c"), "ticker"))
    return (
        daily.groupBy("sector", "date_id")
        .agg(F.min(best).alias("best"), F.min(worst).alias("worst"))
        .select(
            "sector",
            "date_id",
            F.col("best.ticker").alias("top_gainer_ticker"),
            F.col("worst.ticker").alias("top_loser_ticker"),
        )
    )


def daily_extras(daily: DataFrame) -> DataFrame:
    return daily.select(
        "ticker",
        "sector",
        "date_id",
        safe_ratio(F.col("total_volume"), F.col("tick_count")).alias("avg_volume_per_minute"),
        (F.col("close_price") - F.col("open_price")).alias("price_change"),
    )


def sector_trend(summary: DataFrame) -> DataFrame:
    """Sector change against the previous day with data, a week and a month ago."""
    by_sector = W.partitionBy("sector")
    by_day = by_sector.orderBy(_day_number())
    value = F.col("avg_price_change_pct")

    def days_ago(days: int) -> Column:
        return F.max(value).over(by_day.rangeBetween(-days, -days))

    return summary.select(
        "sector",
        "date_id",
        "avg_price_change_pct",
        (value - F.lag(value).over(by_day)).alias("change_vs_previous_day"),
        (value - days_ago(7)).alias("change_vs_week_ago"),
        (value - days_ago(28)).alias("change_vs_four_weeks_ago"),
    )


def ticker_history(ticks: DataFrame) -> DataFrame:
    """Type-2 history of a ticker's sector: one row per period of unchanged sector.

    Ticks are reduced to days first; when a day saw several sectors, the latest tick
    decides. The first step keeps only a time in its aggregation buffer, so it stays a
    hash aggregation over the ticks; the text column is picked from the few rows left.
    """
    day = F.to_date("timestamp").alias("date_id")
    seen = ticks.groupBy("ticker", day, "sector").agg(F.max("timestamp").alias("last_ts"))
    daily = seen.groupBy("ticker", "date_id").agg(F.max_by("sector", "last_ts").alias("sector"))
    by_day = W.partitionBy("ticker").orderBy("date_id")
    changed = ~F.col("sector").eqNullSafe(F.lag("sector").over(by_day))
    first = F.row_number().over(by_day) == 1
    starts = daily.select("ticker", "sector", "date_id", (first | changed).alias("_starts")).filter(
        "_starts"
    )
    following = F.lead("date_id").over(by_day)
    return starts.select(
        "ticker",
        "sector",
        F.col("date_id").alias("valid_from"),
        F.date_sub(following, 1).alias("valid_to"),
        following.isNull().alias("is_current"),
    )


def moving_average(daily: DataFrame, days: int = 5) -> DataFrame:
    """Mean of the last ``days`` daily closes of each ticker (rows, not calendar days)."""
    frame = W.partitionBy("ticker", "sector").orderBy("date_id").rowsBetween(-days + 1, 0)
    return daily.select(
        "ticker",
        "sector",
        "date_id",
        "close_price",
        F.avg("close_price").over(frame).alias("close_moving_average"),
    )


def rolling_volume_score(daily: DataFrame, days: int = 7) -> DataFrame:
    """z-score of each day's volume against the week before it, the day left out.

    Leaving the scored day out removes the ceiling that a sample z-score has when the
    value is part of its own sample.
    """
    week = W.partitionBy("ticker").orderBy(_day_number()).rangeBetween(-days, -1)
    mean, deviation = F.col("mean_volume"), F.col("stddev_volume")
    return (
        daily.select("ticker", "sector", "date_id", "total_volume")
        .withColumn("mean_volume", F.avg("total_volume").over(week))
        .withColumn("stddev_volume", F.stddev_samp("total_volume").over(week))
        .withColumn(
            "volume_z_score",
            F.when(deviation > 0, safe_ratio(F.col("total_volume") - mean, deviation)),
        )
    )


def dead_letter_rate(
    parsed: DataFrame, time: str, width: str = "1 hour", limit: float = 0.05
) -> DataFrame:
    """Share of rejected messages per interval of receipt, flagged above ``limit``."""
    rejected = F.col("reject_reason").isNotNull()
    windows = parsed.groupBy("topic", F.window(time, width)).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(rejected).alias("rejected")
    )
    share = safe_ratio(F.col("rejected"), F.col("messages"))
    return windows.select(
        "topic",
        F.col("window.start").alias("window_start"),
        "messages",
        "rejected",
        share.alias("dead_letter_rate"),
        (share > limit).alias("is_high"),
    )


def silent_periods(messages: DataFrame, time: str, minutes: int = 10, as_of: AsOf | None = None) -> DataFrame:
    """Gaps of more than ``minutes`` without a message.

    Messages are first reduced to the minutes that saw one, so the ordered pass runs
    over clock minutes per topic, however many messages there are. With ``as_of`` the time
    from the last message until then is a gap as well, with no ``next_minute``.
    """
    minute = F.date_trunc("minute", F.col(time))
    active = messages.groupBy("topic", minute.alias("last_minute")).agg(F.lit(1).alias("_seen"))
    following = F.lead("last_minute").over(W.partitionBy("topic").orderBy("last_minute"))
    end = F.col("next_minute") if as_of is None else F.coalesce("next_minute", F.date_trunc("minute", as_of.now))
    gap = F.floor((F.unix_timestamp(end) - F.unix_timestamp("last_minute")) / 60)
    return (
        active.withColumn("next_minute", following)
        .select("topic", "last_minute", "next_minute", gap.cast("bigint").alias("gap_minutes"))
        .filter(F.col("gap_minutes") > minutes)
    )


def silent_feeds(messages: DataFrame, time: str, expected: DataFrame, as_of: AsOf = AsOf(), minutes: int = 10) -> DataFrame:
    """Every expected feed with its last message before ``as_of`` and whether it is silent now.

    ``expected`` has one row per ``feed``; messages carry it in a column of that name. A feed
    that never sent anything is silent. The batch twin of ``streaming.silence``.
    """
    past = messages.filter(F.col(time) <= as_of.now)
    last = past.groupBy("feed").agg(F.max(time).alias("last_seen"))
    seconds = F.unix_timestamp(as_of.now) - F.unix_timestamp("last_seen")
    return expected.join(last, "feed", "left").select(
        "feed", "last_seen", seconds.alias("silent_seconds"), F.coalesce(seconds > minutes * 60, F.lit(True)).alias("is_silent")
    )
