"""Data-quality checks: declared as predicates, evaluated together in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.asof import AsOf
from tickloom.functions import safe_ratio
from tickloom.operators.rank import top_within
from tickloom.schemas import DQ_RESULT, TICK_COLUMNS
from tickloom.sources.reference import ACCEPTED_SECTORS

# Price tolerance, age limit and the columns that must be filled.
PRICE_TOLERANCE = 0.001
STALE_HOURS = 1
REQUIRED_COLUMNS = ("ticker", "sector", "timestamp", "close", "volume", "date_id")


@dataclass(frozen=True)
class Check:
    """Rows in ``scope`` (all rows if None) for which ``failed`` holds are failures.

    A NULL predicate is no failure, as in a WHERE clause.
    """

    check_id: str
    check_name: str
    failed: Column
    scope: Column | None = None
    severity: str = "warning"


def price_logic() -> Column:
    close = F.col("close")
    return (close < F.col("low") * (1 - PRICE_TOLERANCE)) | (
        close > F.col("high") * (1 + PRICE_TOLERANCE)
    )


def tick_checks(as_of: AsOf = AsOf(), scope: Column | None = None) -> list[Check]:
    """The four tick checks. By default they look at today's rows; the day filter
    makes a NULL time unreachable for the third one, so ``missing_keys`` repeats it
    over all rows.
    """
    today = F.to_date("timestamp") == as_of.today if scope is None else scope
    missing = F.col("ticker").isNull() | F.col("timestamp").isNull()
    stale = F.col("timestamp") < as_of.hours_before_now(STALE_HOURS)
    return [
        Check("ohlcv_logic", "Close between low and high", price_logic(), today, "critical"),
        Check("negative_volume", "Volume not negative", F.col("volume") < 0, today, "critical"),
        Check("null_critical_fields", "Ticker and time present", missing, today, "critical"),
        Check("stale_data", "Not older than an hour", stale, today, "warning"),
    ]


def missing_keys() -> Check:
    missing = F.col("ticker").isNull() | F.col("timestamp").isNull()
    return Check("null_critical_fields_all", "Ticker and time present (all rows)", missing, None, "critical")


def expression_checks() -> list[Check]:
    return [
        Check("close_positive", "Close above zero", ~(F.col("close") > 0), None, "critical"),
        Check("volume_nonneg", "Volume at least zero", ~(F.col("volume") >= 0), None, "critical"),
    ]


def not_null_checks(columns: Sequence[str] = REQUIRED_COLUMNS) -> list[Check]:
    return [
        Check(f"not_null_{c}", f"{c} present", F.col(c).isNull(), None, "critical") for c in columns
    ]


def accepted_sector_check(accepted: Sequence[str] = tuple(ACCEPTED_SECTORS)) -> Check:
    outside = ~F.col("sector").isin(list(accepted))
    return Check("accepted_sector", "Known sector", outside, None, "warning")


def check_counts(checks: Sequence[Check]) -> list[Column]:
    """Two aggregates per check: rows in its scope, and failures."""
    counts = []
    for i, check in enumerate(checks):
        scope = F.lit(True) if check.scope is None else F.coalesce(check.scope, F.lit(False))
        failed = scope & F.coalesce(check.failed, F.lit(False))
        counts += [F.count_if(scope).alias(f"_total_{i}"), F.count_if(failed).alias(f"_failed_{i}")]
    return counts


def check_results(counted: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """One result row per check (and group) from rows of ``check_counts``."""
    results = [
        F.struct(
            F.lit(check.check_id).alias("check_id"),
            F.lit(check.check_name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            F.col(f"_total_{i}").alias("total_rows"),
            F.col(f"_failed_{i}").alias("failed_rows"),
        )
        for i, check in enumerate(checks)
    ]
    unfolded = counted.select(*by, F.inline(F.array(*results)))
    rate = safe_ratio(F.col("failed_rows"), F.col("total_rows"))
    return unfolded.withColumn("failure_rate", rate)


def evaluate(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """All checks over ``df`` in one aggregation, one result row per check (and group).

    The scan is shared, partial counts are combined before the shuffle, and only the
    aggregated row is unfolded.
    """
    return check_results(df.groupBy(*by).agg(*check_counts(checks)), checks, by)


def result_log(
    results: DataFrame, as_of: AsOf = AsOf(), batch_id: str = "manual", stage: str = "post_load"
) -> DataFrame:
    """Check results in the layout of the quality log table."""
    details = F.to_json(F.struct("failed_rows", "total_rows"))
    return results.select(
        "check_id",
        "check_name",
        F.lit(stage).alias("stage"),
        F.lit(batch_id).alias("batch_id"),
        as_of.now.alias("execution_ts"),
        "total_rows",
        "failed_rows",
        "failure_rate",
        details.alias("details"),
        "severity",
    ).select(*[F.col(f.name).cast(f.dataType) for f in DQ_RESULT.fields])


def report(log: DataFrame, as_of: AsOf = AsOf(), n: int = 10) -> DataFrame:
    """Today's ``n`` worst checks."""
    return (
        log.filter(F.to_date("execution_ts") == as_of.today)
        .select("check_name", "failed_rows", "failure_rate")
        .orderBy(F.col("failure_rate").desc_nulls_last(), "check_name")
        .limit(n)
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp")) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values of ``column`` outside the (program-defined) list, with their row counts."""
    outside = df.filter(~F.col(column).isin(list(accepted)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def sector_coverage(ticks: DataFrame, universe: DataFrame) -> DataFrame:
    """Expected, observed and missing tickers of each expected sector.

    Ticks are reduced to listed tickers before anything is shuffled.
    """
    observed = ticks.join(universe, ["sector", "ticker"]).select("sector", "ticker")
    seen = observed.groupBy("sector", "ticker").agg(F.lit(1).alias("seen"))
    return (
        universe.join(seen, ["sector", "ticker"], "left")
        .groupBy("sector")
        .agg(
            F.count(F.lit(1)).alias("expected_tickers"),
            F.count("seen").alias("observed_tickers"),
            F.count_if(F.col("seen").isNull()).alias("missing_tickers"),
        )
    )


def missing_tickers(ticks: DataFrame, universe: DataFrame) -> DataFrame:
    """Listed tickers without a single tick."""
    observed = ticks.join(universe.select("ticker"), "ticker", "left_semi")
    return universe.join(observed.select("ticker").distinct(), "ticker", "left_anti")


def universe_activity(ticks: DataFrame, universe: DataFrame) -> DataFrame:
    """Tick count of every listed ticker, zero included."""
    listed = ticks.join(universe.select("ticker"), "ticker", "left_semi")
    counts = listed.groupBy("ticker").agg(F.count(F.lit(1)).alias("tick_count"))
    return universe.join(counts, "ticker", "left").select(
        "sector", "ticker", F.coalesce("tick_count", F.lit(0)).cast("bigint").alias("tick_count")
    )


def ticker_coverage(ticks: DataFrame, universe: DataFrame) -> DataFrame:
    """Listed tickers with and without data, per day that has a tick of any ticker. Days without
    one are in ``calendar.coverage_by_day``."""
    listed = universe.select("ticker").distinct().withColumn("_listed", F.col("ticker"))
    days = ticks.select(F.to_date("timestamp").alias("date_id"), "ticker").join(listed, "ticker", "left")
    daily = days.groupBy("date_id").agg(F.count_distinct("_listed").alias("tickers_succeeded"))
    expected = universe.agg(F.count_distinct("ticker")).scalar()
    return daily.withColumn("tickers_failed", expected - F.col("tickers_succeeded"))


def null_profile(df: DataFrame, columns: Sequence[str] = TICK_COLUMNS) -> DataFrame:
    """NULLs per column and day, one pass."""
    checks = not_null_checks(columns)
    dated = df.withColumn("date_id", F.to_date("timestamp"))
    return evaluate(dated, checks, ["date_id"]).select(
        "date_id",
        F.regexp_replace("check_id", "^not_null_", "").alias("column_name"),
        "total_rows",
        F.col("failed_rows").alias("null_rows"),
    )


def daily_trend(daily_results: DataFrame, n: int = 3) -> DataFrame:
    """Failure rate per check and day with its change, and the day's worst ``n``.

    ``daily_results`` has one row per check and day.
    """
    previous = W.partitionBy("check_id").orderBy("date_id")
    before = F.lag("failure_rate").over(previous)
    change = F.col("failure_rate") - F.col("previous_rate")
    trended = (
        daily_results.select("date_id", "check_id", "failed_rows", "failure_rate")
        .withColumn("previous_rate", before)
        .withColumn(
            "trend",
            F.when(change > 0, "up").when(change < 0, "down").when(change == 0, "same"),
        )
    )
    order = [F.col("failure_rate").desc_nulls_last(), F.col("check_id").asc()]
    return top_within(trended, n, "failure_rank", ["date_id"], order)


def row_balance(ticks: DataFrame, staged: DataFrame, daily: DataFrame, universe: DataFrame) -> DataFrame:
    """Row counts that must agree between the layers, and ticks of unlisted tickers.

    Three one-row aggregates; nothing but counts is combined.
    """
    orphans = ticks.join(universe.select("ticker"), "ticker", "left_anti")
    return (
        staged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("staged_rows").alias("measure"), "n")
        .unionByName(
            daily.agg(F.sum("tick_count").alias("n")).select(
                F.lit("daily_stats_ticks").alias("measure"), "n"
            )
        )
        .unionByName(
            orphans.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("unlisted_ticker_rows").alias("measure"), "n"
            )
        )
        .withColumnRenamed("n", "row_count")
    )
