"""Every registered query: the library's operators applied to the tick relations that
Spark derives from ``events`` (see ``tickloom.sources.events``).

The reference instant is fixed; results are published with zone-less times and doubles
rounded to six digits, so that they compare with another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.asof import AsOf
from tickloom.operators import dedup
from tickloom.operators.clean import clean_ticks
from tickloom.operators.message import to_messages
from tickloom.operators.parse import (
    as_dead_letters,
    field_drift,
    header_value,
    malformed_messages,
    parse_by_version,
    parse_messages,
    usable_records,
)
from tickloom.plans import calendar, extensions, models, quality, reconcile, refresh, reports
from tickloom.schemas import SCHEMA_NAME, TICK_COLUMNS, TICK_JSON_V1
from tickloom.session import ensure_checkpoint_dir, use_session_defaults
from tickloom.sources.events import EventTicks, arrival_order, fixture_universe
from tickloom.sources.files import with_sector
from tickloom.sources.reference import ACCEPTED_SECTORS, sector_mapping, universe

AS_OF = AsOf("2024-01-30 12:00:00")
TODAY = "2024-01-30 00:00:00"
WEEK_START = "2024-01-23 00:00:00"
FORTNIGHT_START = "2024-01-16 12:00:00"
ALREADY_SENT_BEFORE = "2024-01-20 00:00:00"
RECLASSIFIED_ON = "2024-01-16"
# The calendar runs a week beyond the data: trading days on which every ticker is missing.
MONTH_START, MONTH_END, HOLIDAY = "2024-01-01", "2024-02-07", "2024-01-01"
BATCH_ID = "batch-1"
# Two loads: the first ends in the middle of a day, which the second one sends again, whole.
FIRST_LOAD_UNTIL = "2024-01-16 12:00:00"
SECOND_LOAD_FROM = "2024-01-16 00:00:00"
DIGITS = 6
# Many results are short decimals that end in a five at the seventh digit, where the
# order of a sum decides the rounding. This relative shift moves them off the tie.
OFF_TIE = 1 + 1e-11

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def publish(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Zone-less times and rounded doubles; ``rounded`` names columns that already are."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return value.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DoubleType) and field.name not in rounded:
            return F.round(value * OFF_TIE, DIGITS).alias(field.name)
        return value

    return df.select(*[column(f) for f in df.schema.fields])


class Scope:
    """The relations a query starts from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_session_defaults(spark)
        self.source = EventTicks(spark, folder)

    def ticks(self, since: str | None = None, until: str | None = None) -> DataFrame:
        return self.source.ticks(since, until)

    def staged(self, since: str | None = None) -> DataFrame:
        return models.staged_ticks(self.ticks(since), AS_OF)

    def daily(self, since: str | None = None) -> DataFrame:
        """``since`` is the start of a day: whole days only."""
        return models.daily_stock_stats(self.staged(since))

    def today(self) -> DataFrame:
        return self.daily(TODAY).filter(F.col("date_id") == AS_OF.today)

    def summary(self) -> DataFrame:
        return models.sector_daily_summary(self.daily())

    def universe(self) -> DataFrame:
        return universe(self.spark, fixture_universe())

    def parsed(self, *keep: str) -> DataFrame:
        return parse_messages(self.source.messages(), keep=keep)

    def star(self, since: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Fact and dimensions; ``since`` limits the fact only.

        Repeated ticks agree in ticker, sector and day, so the dimensions are read from
        the cleaned rows: no de-duplication shuffle for them.
        """
        tickers, sectors = models.dimensions(self.source.clean(), AS_OF)
        return models.fct_intraday_ticks(self.ticks(since), tickers, sectors), tickers, sectors

    def loaded(self, *names: str) -> Callable[[str], DataFrame]:
        """Model tables after two incremental loads below a new folder."""
        root = f"{ensure_checkpoint_dir(self.spark)}/loads-{uuid.uuid4().hex}"
        for ticks in (self.ticks(until=FIRST_LOAD_UNTIL), self.ticks(SECOND_LOAD_FROM)):
            status = refresh.refresh(ticks, root, AS_OF, set(names), "partitions")
            failed = status.filter("status <> 'ok'").collect()
            if failed:
                raise RuntimeError(f"load failed: {failed}")
        return lambda name: refresh.read_table(self.spark, root, name)

    def ticker_stats(self, since: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        fact, tickers, sectors = self.star(since)
        return extensions.daily_ticker_stats(fact, AS_OF), tickers, sectors


def query(name: str | None = None, rounded: tuple[str, ...] = ()):
    """Register a function of a ``Scope`` as a query."""

    def register(build: Callable[[Scope], DataFrame]) -> Callable[[Scope], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return publish(build(Scope(spark, folder)), rounded)

        run.__name__ = name or build.__name__
        QUERIES[run.__name__] = run
        return build

    return register


# --- scans and sources -------------------------------------------------------


@query()
def raw_scan(s: Scope) -> DataFrame:
    return s.ticks()


@query()
def table_row_count(s: Scope) -> DataFrame:
    return reports.table_size(s.source.raw())


@query()
def seed_sector_mapping(s: Scope) -> DataFrame:
    """Sectors seen in the data with their seed category (NULL where the seed has none)."""
    seen = s.source.clean().groupBy("sector").agg(F.count(F.lit(1)).alias("tick_count"))
    seed = sector_mapping(s.spark)
    return seen.join(seed, seen.sector == seed.sector_name, "left").select(
        "sector", "category", "tick_count"
    )


@query()
def universe_explode(s: Scope) -> DataFrame:
    return quality.universe_activity(s.ticks(), s.universe())


@query()
def candles_with_sector(s: Scope) -> DataFrame:
    candles = s.ticks().drop("sector", "fetch_ts")
    return with_sector(candles, s.universe())


# --- ingest ------------------------------------------------------------------


@query()
def parse_valid(s: Scope) -> DataFrame:
    return usable_records(s.parsed()).select(
        F.col("offset").alias("message_offset"),
        "ticker",
        "sector",
        "timestamp",
        "fetch_ts",
        F.isnan("open").alias("open_is_nan"),
        "high",
        "low",
        "close",
        "volume",
        "partially_corrupt",
    )


@query()
def dlq_records(s: Scope) -> DataFrame:
    letters = as_dead_letters(malformed_messages(s.parsed()))
    layout = "json_str STRING, topic STRING, partition INT, offset BIGINT"
    return letters.select(F.inline(F.array(F.from_json("value", layout)))).withColumnsRenamed(
        {"partition": "source_partition", "offset": "source_offset"}
    )


@query(name="clean_ticks")
def clean_ticks_from_json(s: Scope) -> DataFrame:
    return clean_ticks(usable_records(s.parsed())).select(*TICK_COLUMNS)


@query()
def dedup_ticks(s: Scope) -> DataFrame:
    """From JSON to the tick table: parse, clean, first of each (ticker, timestamp)."""
    cleaned = clean_ticks(usable_records(s.parsed()))
    unique = dedup.first_per_key(cleaned, ["ticker", "timestamp"], ["fetch_ts", "offset"])
    return unique.select("ticker", "timestamp", "fetch_ts", "close", "volume")


@query()
def high_water_mark_dedup(s: Scope) -> DataFrame:
    arrived = s.source.clean().withColumn("arrival", arrival_order())
    kept = dedup.rising_only(arrived, "ticker", "arrival", "timestamp")
    return kept.select("event_id", "ticker", "timestamp", "close", "volume")


@query()
def incremental_new_ticks(s: Scope) -> DataFrame:
    sent = s.source.clean(until=ALREADY_SENT_BEFORE)
    return dedup.newer_than(s.ticks(), dedup.high_water(sent)).select(
        "ticker", "sector", "timestamp", "close", "volume"
    )


@query()
def to_message_json(s: Scope) -> DataFrame:
    """Messages read back as records."""
    messages = to_messages(s.ticks())
    record = F.from_json("value", TICK_JSON_V1, {"mode": "FAILFAST"})
    return messages.select("value", "headers", F.inline(F.array(record))).select(
        "ticker",
        "sector",
        F.col("timestamp").alias("event_time"),
        F.col("fetch_ts").alias("fetch_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.size(F.json_object_keys("value")).alias("field_count"),
        header_value(F.col("headers"), "schema_name").alias("schema_name"),
        header_value(F.col("headers"), "schema_version").alias("schema_version"),
    )


@query()
def market_hours_flag(s: Scope) -> DataFrame:
    return reports.market_hours(s.ticks())


@query()
def schema_drift_profile(s: Scope) -> DataFrame:
    return field_drift(s.source.messages())


# --- staging, dimensions, fact -----------------------------------------------


@query()
def stg_ticks(s: Scope) -> DataFrame:
    return s.staged()


@query()
def stg_ticks_14d(s: Scope) -> DataFrame:
    return models.staged_ticks(s.ticks(FORTNIGHT_START), AS_OF, days=14)


@query()
def dim_ticker(s: Scope) -> DataFrame:
    return models.dim_ticker(s.source.clean(), AS_OF)


@query()
def dim_sector(s: Scope) -> DataFrame:
    return reports.sectors_by_category(models.dim_sector(s.source.clean()))


@query()
def dim_sector_seeded(s: Scope) -> DataFrame:
    return models.dim_sector(s.source.clean(), sector_mapping(s.spark))


@query()
def active_tickers(s: Scope) -> DataFrame:
    return reports.active_tickers(models.dim_ticker(s.source.clean(), AS_OF))


@query()
def fct_intraday_ticks(s: Scope) -> DataFrame:
    fact, _, _ = s.star()
    return fact


@query()
def star_today(s: Scope) -> DataFrame:
    fact, tickers, sectors = s.star(TODAY)
    return reports.star_of_day(fact, tickers, sectors, AS_OF)


# --- intermediate ------------------------------------------------------------


@query()
def int_daily_stock_stats(s: Scope) -> DataFrame:
    return s.daily()


@query()
def int_sector_daily_summary(s: Scope) -> DataFrame:
    return s.summary()


@query()
def int_ticker_rankings(s: Scope) -> DataFrame:
    return models.ticker_rankings(s.daily())


@query()
def volume_stats_7d(s: Scope) -> DataFrame:
    return models.volume_stats(s.daily(WEEK_START), AS_OF)


@query()
def sector_rank_over_agg(s: Scope) -> DataFrame:
    return models.sector_performance_ranks(models.sector_totals(s.daily()))


# --- marts -------------------------------------------------------------------


@query()
def mrt_top5_sector_daily(s: Scope) -> DataFrame:
    return models.top5_sector_daily(models.ticker_rankings(s.daily()))


@query()
def mrt_sector_performance(s: Scope) -> DataFrame:
    return models.sector_performance(s.summary())


@query()
def mrt_sector_performance_sk(s: Scope) -> DataFrame:
    return models.sector_performance(s.summary(), models.dim_sector(s.source.clean()))


@query()
def mrt_market_breadth(s: Scope) -> DataFrame:
    return models.market_breadth(s.daily())


@query()
def mrt_volume_anomalies(s: Scope) -> DataFrame:
    return models.volume_anomalies(s.daily(WEEK_START), AS_OF)


@query()
def anomaly_severity(s: Scope) -> DataFrame:
    anomalies = models.volume_anomalies(s.daily(WEEK_START), AS_OF)
    return models.anomaly_severity(anomalies).select(
        "ticker", "sector", "date_id", "volume_z_score", "severity"
    )


# --- user queries ------------------------------------------------------------


@query(rounded=("close_price", "change_pct"))
def adhoc_top5_today(s: Scope) -> DataFrame:
    return reports.top5_today(models.top5_sector_daily(models.ticker_rankings(s.today())), AS_OF)


@query()
def top_gainers_today(s: Scope) -> DataFrame:
    return reports.top_gainers(s.today(), AS_OF)


@query()
def ticker_day_latest5(s: Scope) -> DataFrame:
    return reports.latest_ticks_per_day(s.ticks()).select(
        "ticker", "date_id", "timestamp", "close", "volume", "recency_rank"
    )


@query()
def sector_leaderboard_today(s: Scope) -> DataFrame:
    return reports.sector_leaderboard(models.sector_daily_summary(s.today()), AS_OF)


@query()
def market_breadth_today(s: Scope) -> DataFrame:
    return reports.breadth_of_day(models.market_breadth(s.today()), AS_OF)


@query()
def ticks_per_ticker(s: Scope) -> DataFrame:
    return reports.ticks_per_ticker(s.ticks())


@query()
def ticks_per_minute(s: Scope) -> DataFrame:
    return reports.ticks_per_minute(s.source.clean())


@query()
def recent_hour_health(s: Scope) -> DataFrame:
    return reports.recent_hour(s.ticks(since="2024-01-30 11:00:00"), AS_OF)


# --- quality -----------------------------------------------------------------


def _tick_check(s: Scope, check_id: str) -> DataFrame:
    checks = [c for c in quality.tick_checks(AS_OF) if c.check_id == check_id]
    return quality.evaluate(s.ticks(TODAY), checks).select(
        "check_id", "failed_rows", "failure_rate"
    )


@query()
def dq_ohlcv_logic(s: Scope) -> DataFrame:
    return _tick_check(s, "ohlcv_logic")


@query()
def dq_negative_volume(s: Scope) -> DataFrame:
    return _tick_check(s, "negative_volume")


@query()
def dq_stale(s: Scope) -> DataFrame:
    return _tick_check(s, "stale_data")


@query()
def dq_null_critical(s: Scope) -> DataFrame:
    """Today's rows as the check is written, and all rows."""
    today = [c for c in quality.tick_checks(AS_OF) if c.check_id == "null_critical_fields"]
    return quality.evaluate(s.source.raw(), [*today, quality.missing_keys()]).select(
        "check_id", "total_rows", "failed_rows", "failure_rate"
    )


@query()
def dq_not_null(s: Scope) -> DataFrame:
    staged = models.staged_ticks(s.source.raw(), AS_OF)
    return quality.evaluate(staged, quality.not_null_checks()).select(
        "check_id", "total_rows", "failed_rows"
    )


@query()
def dq_unique_ticker_ts(s: Scope) -> DataFrame:
    return quality.repeated_keys(s.source.clean())


@query()
def dq_accepted_values_sector(s: Scope) -> DataFrame:
    return quality.unexpected_values(s.ticks(), "sector", ACCEPTED_SECTORS)


def _expression_check(s: Scope, check_id: str) -> DataFrame:
    checks = [c for c in quality.expression_checks() if c.check_id == check_id]
    return quality.evaluate(s.staged(), checks).select(
        "check_id", "total_rows", "failed_rows", "failure_rate"
    )


@query()
def dq_expr_close_positive(s: Scope) -> DataFrame:
    return _expression_check(s, "close_positive")


@query()
def dq_expr_volume_nonneg(s: Scope) -> DataFrame:
    return _expression_check(s, "volume_nonneg")


@query()
def dq_sector_coverage(s: Scope) -> DataFrame:
    return quality.sector_coverage(s.source.clean(), s.universe())


def _expected(s: Scope) -> DataFrame:
    """Listed tickers of every trading day; ticker n is listed from the (n mod 20)th day on."""
    number = F.substring("ticker", 2, 6).cast("int")
    start = F.date_add(F.lit(MONTH_START).cast("date"), number % 20)
    listing = s.universe().select("ticker", "sector", start.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return calendar.listed_days(listing, calendar.trading_days(s.spark, MONTH_START, MONTH_END, (HOLIDAY,)))


@query()
def dq_missing_tickers(s: Scope) -> DataFrame:
    """Listed tickers without a tick, on every trading day of the month."""
    return calendar.missing_by_day(s.source.clean(), _expected(s))


@query()
def ticker_coverage_calendar(s: Scope) -> DataFrame:
    return calendar.coverage_by_day(s.source.clean(), _expected(s))


def _all_checks(df: DataFrame) -> DataFrame:
    checks = [
        *quality.tick_checks(AS_OF),
        quality.missing_keys(),
        *quality.expression_checks(),
        quality.accepted_sector_check(),
        *quality.not_null_checks(("ticker", "sector", "timestamp", "close", "volume")),
    ]
    return quality.result_log(quality.evaluate(df, checks), AS_OF, BATCH_ID)


@query()
def dq_all_checks(s: Scope) -> DataFrame:
    return _all_checks(s.source.raw())


@query()
def dq_report_top10(s: Scope) -> DataFrame:
    return quality.report(_all_checks(s.source.raw()), AS_OF)


@query()
def freshness(s: Scope) -> DataFrame:
    return reports.freshness(reports.recent_part(s.source.clean, AS_OF), AS_OF)


@query()
def ticker_coverage(s: Scope) -> DataFrame:
    return quality.ticker_coverage(s.source.clean(), s.universe())


# --- extensions --------------------------------------------------------------


@query()
def agg_daily_ticker(s: Scope) -> DataFrame:
    stats, _, _ = s.ticker_stats(WEEK_START)
    return extensions.daily_ticker_aggregate(stats)


@query()
def agg_sector_hourly(s: Scope) -> DataFrame:
    return extensions.sector_hourly(s.staged())


@query()
def view_top5_sector_by_volume(s: Scope) -> DataFrame:
    return extensions.top5_view(*s.ticker_stats(TODAY), AS_OF)


@query()
def view_market_summary(s: Scope) -> DataFrame:
    stats, _, _ = s.ticker_stats(TODAY)
    return extensions.market_summary(stats, AS_OF)


@query()
def sector_top_gainer_loser(s: Scope) -> DataFrame:
    return extensions.gainers_and_losers(s.daily())


@query()
def daily_stats_extra(s: Scope) -> DataFrame:
    return extensions.daily_extras(s.daily())


@query()
def sector_performance_delta(s: Scope) -> DataFrame:
    return extensions.sector_trend(s.summary())


@query()
def ticker_scd2(s: Scope) -> DataFrame:
    """History of a list in which every seventh ticker moves to Technology mid-month."""
    ticks = s.ticks()
    number = F.substring("ticker", 2, 6).cast("int")
    moves = (number % 7 == 3) & (F.to_date("timestamp") >= F.lit(RECLASSIFIED_ON).cast("date"))
    reclassified = F.when(moves, "Technology").otherwise(F.col("sector"))
    return extensions.ticker_history(ticks.withColumn("sector", reclassified))


@query()
def dq_summary_trend(s: Scope) -> DataFrame:
    dated = s.source.raw().withColumn("date_id", F.to_date("timestamp"))
    checks = [
        *quality.tick_checks(AS_OF, scope=F.lit(True)),
        *quality.not_null_checks(("close", "volume")),
    ]
    return quality.daily_trend(quality.evaluate(dated, checks, ["date_id"]))


@query()
def null_profile(s: Scope) -> DataFrame:
    return quality.null_profile(s.source.raw())


@query()
def moving_average_close(s: Scope) -> DataFrame:
    return extensions.moving_average(s.daily())


@query()
def dlq_rate(s: Scope) -> DataFrame:
    return extensions.dead_letter_rate(s.parsed("received_ts"), "received_ts")


@query()
def no_data_gaps(s: Scope) -> DataFrame:
    return extensions.silent_periods(s.source.messages(), "received_ts")


@query()
def dq_referential(s: Scope) -> DataFrame:
    return quality.row_balance(s.ticks(), s.staged(), s.daily(), s.universe())


@query()
def volume_z_rolling(s: Scope) -> DataFrame:
    return extensions.rolling_volume_score(s.daily())


# --- incremental loads -------------------------------------------------------

KEYED = ("keys_ticker", "keys_sector", "dim_ticker", "dim_sector")


@query()
def fct_incremental(s: Scope) -> DataFrame:
    return s.loaded(*KEYED, "fct_intraday_ticks")("fct_intraday_ticks")


@query()
def dim_ticker_merged(s: Scope) -> DataFrame:
    return s.loaded("keys_ticker", "dim_ticker")("dim_ticker")


@query()
def agg_sector_hourly_merged(s: Scope) -> DataFrame:
    return s.loaded("agg_sector_hourly")("agg_sector_hourly")


# --- feeds, versions, reconciliation -----------------------------------------


@query()
def route_versions(s: Scope) -> DataFrame:
    """Messages of two known versions, an unknown one and another schema, counted by outcome."""
    number = F.col("offset") % 7
    header = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))
    version = F.when(number < 3, "1").when(number < 5, "2").otherwise("9")
    name = F.when(F.col("offset") % 13 == 5, "other").otherwise(SCHEMA_NAME)
    headers = F.array(header("schema_name", name), header("schema_version", version))
    marked = s.source.messages().withColumn("headers", F.when(number > 0, headers))
    contracts = {"1": TICK_JSON_V1, "2": T.StructType([*TICK_JSON_V1.fields, T.StructField("bid", T.DoubleType())])}
    routed = parse_by_version(marked, contracts)
    return routed.groupBy("schema_version", F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"), F.count("bid").alias("bids"), F.count("ticker").alias("tickers")
    )


@query()
def silent_feeds(s: Scope) -> DataFrame:
    """Feeds are the partitions of the topic; a fifth one is expected and never sends."""
    expected = s.spark.range(5).select(F.concat(F.lit("ticks-"), F.col("id").cast("string")).alias("feed"))
    named = s.source.messages().withColumn("feed", F.concat_ws("-", "topic", F.col("partition").cast("string")))
    return extensions.silent_feeds(named, "received_ts", expected, AS_OF)


@query()
def layer_fingerprints(s: Scope) -> DataFrame:
    """Ticks and staged ticks per day, over the columns that they share."""
    text = F.concat_ws(
        "|", "ticker", F.unix_timestamp("timestamp").cast("string"), F.coalesce(F.col("volume").cast("string"), F.lit(""))
    )
    value = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    layers = {"ticks": s.ticks(), "staged": s.staged()}
    prints = [
        reconcile.fingerprint(frame, [], F.to_date("timestamp"), value).select(F.lit(name).alias("layer"), "*")
        for name, frame in layers.items()
    ]
    return prints[0].unionByName(prints[1]).withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query()
def dq_key_integrity(s: Scope) -> DataFrame:
    """All ticks with the keys of the first half of the month, against a dimension that lacks
    the tickers first seen in its last twelve hours."""
    tickers = models.dim_ticker(s.source.clean(until=FIRST_LOAD_UNTIL), AS_OF)
    earlier = s.source.clean(until=SECOND_LOAD_FROM).select(F.col("ticker").alias("ticker_code")).distinct()
    known = tickers.join(earlier, "ticker_code", "left_semi")
    fact = models.fct_intraday_ticks(s.ticks(), tickers, models.dim_sector(tickers))
    return reconcile.key_integrity(fact, known, "ticker_sk")
