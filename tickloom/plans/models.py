"""The star schema, daily statistics, sector roll-ups and marts.

Every model is a function from DataFrames (and a reference instant) to a DataFrame.
``ordered`` adds the report order; a refresh leaves it out, because a table's layout
is decided by the writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.asof import AsOf
from tickloom.functions import display_name, safe_ratio, sector_category
from tickloom.operators.joins import lookup_key
from tickloom.operators.keys import same_values, with_surrogate_key
from tickloom.operators.rank import top_within, with_row_number

# Look-back windows and thresholds of the models.
STAGING_DAYS = 90
ACTIVE_DAYS = 7
ANOMALY_DAYS = 7
ANOMALY_Z = 2.0
FLAT_CHANGE = 0.001
TOP_N = 5
SEVERITY_BANDS = [(5.0, "investigate"), (3.0, "critical"), (2.0, "warning")]

GRAIN = ["ticker", "sector", "date_id"]


# --- staging -----------------------------------------------------------------


def staged_ticks(ticks: DataFrame, as_of: AsOf = AsOf(), days: int = STAGING_DAYS) -> DataFrame:
    """Recent ticks with their UTC day and hour; rows without a time drop out.

    The day column of a stored table is filtered as well, so that old partitions are not read.
    """
    since = as_of.days_before_now(days)
    recent = ticks.filter(F.col("timestamp") >= since)
    if "date_id" in ticks.columns:
        recent = recent.filter(F.col("date_id") >= F.to_date(since))
    return recent.select(
        *[name for name in ticks.columns if name not in ("date_id", "hour_bucket")],
        F.to_date("timestamp").alias("date_id"),
        F.date_trunc("hour", "timestamp").alias("hour_bucket"),
    )


# --- dimensions and fact -----------------------------------------------------


def ticker_spans(ticks: DataFrame) -> DataFrame:
    """First and last day of each (ticker, sector) pair."""
    day = F.to_date("timestamp")
    return ticks.groupBy("ticker", "sector").agg(
        F.min(day).alias("first_seen_date"), F.max(day).alias("last_seen_date")
    )


def dim_ticker(
    ticks: DataFrame, as_of: AsOf = AsOf(), spans: DataFrame | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """One row per (ticker, sector), keyed in ticker order or by the registry ``keys``.

    The spans are aggregated first, so only one row per pair is sorted for the key.
    """
    spans = ticker_spans(ticks) if spans is None else spans
    if keys is None:
        keyed = with_surrogate_key(spans, "ticker_sk", ["ticker", "sector"])
    else:
        same = same_values(spans, keys, ["ticker", "sector"])
        keyed = spans.join(keys.select("ticker_sk", "ticker", "sector"), same).select(keys.ticker_sk, *[spans[c] for c in spans.columns])
    return keyed.select(
        "ticker_sk",
        F.col("ticker").alias("ticker_code"),
        display_name(F.col("ticker")).alias("ticker_name"),
        "sector",
        "first_seen_date",
        "last_seen_date",
        (F.col("last_seen_date") >= as_of.days_before_today(ACTIVE_DAYS)).alias("is_active"),
    )


def dim_sector(
    ticks: DataFrame, mapping: DataFrame | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """One row per sector; the category follows the built-in groups or ``mapping``.

    ``ticks`` may be any relation with a sector column, such as the ticker spans. Keys follow
    the names, or the registry ``keys``.
    """
    distinct = ticks.select("sector").distinct()
    if keys is None:
        keyed = with_surrogate_key(distinct, "sector_sk", ["sector"])
    else:
        keyed = distinct.join(keys.select("sector_sk", "sector"), same_values(distinct, keys, ["sector"])).select(keys.sector_sk, distinct.sector)
    named = keyed.select("sector_sk", F.col("sector").alias("sector_name"))
    if mapping is None:
        return named.withColumn("sector_category", sector_category(F.col("sector_name")))
    seeded = mapping.select("sector_name", F.col("category").alias("sector_category"))
    return named.join(seeded, "sector_name", "left").select(
        "sector_sk", "sector_name", "sector_category"
    )


def dimensions(ticks: DataFrame, as_of: AsOf = AsOf()) -> tuple[DataFrame, DataFrame]:
    """Both dimensions from one pass: sectors are read off the keyed tickers."""
    tickers = dim_ticker(ticks, as_of)
    return tickers, dim_sector(tickers)


def fct_intraday_ticks(ticks: DataFrame, tickers: DataFrame, sectors: DataFrame) -> DataFrame:
    """Ticks with surrogate keys. Rows without a dimension entry keep NULL keys, and a
    ticker listed in two sectors matches both of its dimension rows.
    """
    ticker_keys = tickers.select("ticker_code", "ticker_sk")
    sector_keys = sectors.select("sector_name", "sector_sk")
    keyed = lookup_key(ticks, ticker_keys, F.col("ticker") == F.col("ticker_code"))
    keyed = lookup_key(keyed, sector_keys, F.col("sector") == F.col("sector_name"))
    return keyed.select(
        "ticker_sk",
        "sector_sk",
        "timestamp",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "fetch_ts",
    )


# --- intermediate ------------------------------------------------------------


def candle_stats(staged: DataFrame, keys: list[str]) -> DataFrame:
    """OHLC, volume, VWAP and change per group, in one hash aggregation.

    ``min_by`` / ``max_by`` take the value at the first / last time even when it is
    NULL. In the VWAP a NULL close is missing from the numerator only.
    """
    totals = staged.groupBy(*keys).agg(
        F.min("timestamp").alias("first_tick_ts"),
        F.max("timestamp").alias("last_tick_ts"),
        F.min_by("open", "timestamp").alias("open_price"),
        F.max_by("close", "timestamp").alias("close_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("tick_count"),
        F.sum(F.col("close") * F.col("volume")).alias("_turnover"),
    )
    change = F.col("close_price") - F.col("open_price")
    return totals.select(
        *[c for c in totals.columns if c != "_turnover"],
        safe_ratio(F.col("_turnover"), F.col("total_volume")).alias("vwap"),
        safe_ratio(change, F.col("open_price")).alias("price_change_pct"),
    )


def daily_stock_stats(staged: DataFrame) -> DataFrame:
    return candle_stats(staged, GRAIN)


def _moves() -> list[Column]:
    """Rising, falling and flat counts; a tiny move counts twice (as flat as well)."""
    change = F.col("price_change_pct")
    return [F.count_if(change > 0), F.count_if(change < 0), F.count_if(F.abs(change) < FLAT_CHANGE)]


def sector_totals(daily: DataFrame) -> DataFrame:
    up, down, flat = _moves()
    # Daily rows are unique per (ticker, sector, day): within a sector-day, counting
    # tickers already counts distinct ones, and saves the distinct shuffle.
    return daily.groupBy("sector", "date_id").agg(
        F.count("ticker").alias("ticker_count"),
        F.sum("total_volume").alias("sector_total_volume"),
        F.avg("price_change_pct").alias("avg_price_change_pct"),
        up.alias("tickers_up"),
        down.alias("tickers_down"),
        flat.alias("tickers_flat"),
    )


def sector_performance_ranks(totals: DataFrame) -> DataFrame:
    return with_row_number(
        totals,
        "sector_performance_rank",
        ["date_id"],
        [F.col("avg_price_change_pct").desc_nulls_last(), F.col("sector").asc()],
    )


def sector_daily_summary(daily: DataFrame) -> DataFrame:
    return with_row_number(
        sector_performance_ranks(sector_totals(daily)),
        "sector_volume_rank",
        ["date_id"],
        [F.col("sector_total_volume").desc_nulls_last(), F.col("sector").asc()],
    )


def ticker_rankings(daily: DataFrame, n: int = TOP_N) -> DataFrame:
    """Daily statistics of the ``n`` most traded tickers of each sector-day."""
    order = [F.col("total_volume").desc_nulls_last(), F.col("ticker").asc()]
    return top_within(daily, n, "volume_rank", ["sector", "date_id"], order)


# --- marts -------------------------------------------------------------------


def top5_sector_daily(rankings: DataFrame, ordered: bool = True) -> DataFrame:
    top = rankings.filter(F.col("volume_rank") <= TOP_N).select(
        "sector",
        "date_id",
        "ticker",
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "total_volume",
        "vwap",
        "price_change_pct",
        "volume_rank",
    )
    return top.orderBy("sector", "volume_rank") if ordered else top


def sector_performance(
    summary: DataFrame, sectors: DataFrame | None = None, ordered: bool = True
) -> DataFrame:
    """Sector ranking with the advance/decline ratio; with ``sectors``, keyed."""
    ratio = safe_ratio(F.col("tickers_up"), F.col("tickers_down"))
    result = summary.select(
        "sector",
        "date_id",
        "avg_price_change_pct",
        "sector_total_volume",
        "ticker_count",
        "tickers_up",
        "tickers_down",
        "tickers_flat",
        ratio.alias("advance_decline_ratio"),
        "sector_performance_rank",
        "sector_volume_rank",
    )
    if sectors is not None:
        keys = sectors.select("sector_name", "sector_sk")
        columns = ["sector_sk", *[c for c in result.columns if c != "sector_volume_rank"]]
        result = lookup_key(result, keys, F.col("sector") == F.col("sector_name")).select(*columns)
    return result.orderBy("sector_performance_rank") if ordered else result


def market_breadth(daily: DataFrame, ordered: bool = True) -> DataFrame:
    up, down, flat = _moves()
    breadth = (
        daily.groupBy("date_id")
        .agg(
            F.count_distinct("ticker").alias("total_tickers"),
            up.alias("gainers"),
            down.alias("losers"),
            flat.alias("flat"),
            F.avg("price_change_pct").alias("avg_change_pct"),
            F.sum("total_volume").alias("total_volume"),
        )
        .withColumn("advance_decline_ratio", safe_ratio(F.col("gainers"), F.col("losers")))
    )
    return breadth.orderBy(F.col("date_id").desc()) if ordered else breadth


def _recent_days(daily: DataFrame, as_of: AsOf) -> DataFrame:
    return daily.filter(F.col("date_id") >= as_of.days_before_today(ANOMALY_DAYS))


def volume_stats(daily: DataFrame, as_of: AsOf = AsOf()) -> DataFrame:
    """Mean and sample deviation of daily volume since a week ago, per ticker."""
    return _recent_days(daily, as_of).groupBy("ticker").agg(
        F.avg("total_volume").alias("avg_volume_7d"),
        F.stddev_samp("total_volume").alias("stddev_volume_7d"),
    )


def volume_anomalies(
    daily: DataFrame, as_of: AsOf = AsOf(), threshold: float = ANOMALY_Z, ordered: bool = True
) -> DataFrame:
    """Tickers whose volume yesterday stands out from their own last week.

    Yesterday is one of the days averaged, so a window over the week's daily rows (at
    most one per ticker, sector and day) replaces the self join: the daily statistics
    are computed once.
    """
    per_ticker = W.partitionBy("ticker")
    mean, deviation = F.col("avg_volume_7d"), F.col("stddev_volume_7d")
    scored = (
        _recent_days(daily, as_of)
        .select(*GRAIN, "total_volume")
        .withColumn("avg_volume_7d", F.avg("total_volume").over(per_ticker))
        .withColumn("stddev_volume_7d", F.stddev_samp("total_volume").over(per_ticker))
        .filter((F.col("date_id") == as_of.days_before_today(1)) & (deviation > 0))
        .withColumn("volume_z_score", safe_ratio(F.col("total_volume") - mean, deviation))
        .filter(F.col("volume_z_score") > threshold)
    )
    return scored.orderBy(F.col("volume_z_score").desc()) if ordered else scored


def anomaly_severity(anomalies: DataFrame) -> DataFrame:
    z = F.col("volume_z_score")
    band = F.lit(None).cast("string")
    for floor, name in reversed(SEVERITY_BANDS):
        band = F.when(z > floor, name).otherwise(band)
    return anomalies.withColumn("severity", band)
