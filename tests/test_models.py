"""Models on small inputs with known answers, and their invariants."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom import AsOf
from tickloom.operators.joins import broadcast_within
from tickloom.operators.keys import with_surrogate_key
from tickloom.operators.rank import with_rank_in_large_groups, with_row_number
from tickloom.plans import extensions, models, reports
from tickloom.sources.events import EventTicks
from tickloom.sources.reference import SECTOR_MAPPING, SECTOR_TICKERS, read_seed, sector_mapping, universe
from conftest import DATA

DAY = "2024-01-30"


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def daily_of(ticks, as_of):
    return models.daily_stock_stats(models.staged_ticks(ticks, as_of))


def test_universe(spark):
    df = universe(spark)
    assert df.count() == 55 and df.select("ticker").distinct().count() == 55
    assert {r.sector for r in df.collect()} == set(SECTOR_TICKERS)


def test_seed_file(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text("sector_name,category\n" + "\n".join(",".join(r) for r in SECTOR_MAPPING))
    assert sorted(read_seed(spark, str(path)).collect()) == sorted(sector_mapping(spark).collect())


def test_staging_window(make_ticks, as_of):
    ticks = make_ticks(
        [
            ("A", "S", "2023-11-01 11:59:59", 1.0, 1.0, 1),
            ("A", "S", "2023-11-01 12:00:00", 1.0, 1.0, 1),
            ("A", "S", None, 1.0, 1.0, 1),
        ]
    )
    assert rows(models.staged_ticks(ticks, as_of), "date_id", "hour_bucket")[0][0].isoformat() == "2023-11-01"
    assert models.staged_ticks(ticks, as_of).count() == 1


def test_daily_stats(make_ticks, as_of):
    ticks = make_ticks(
        [
            ("A", "S", f"{DAY} 03:00:00", 10.0, 11.0, 100),
            ("A", "S", f"{DAY} 02:00:00", None, 9.0, 50),
            ("A", "S", f"{DAY} 04:00:00", 12.0, None, None),
        ]
    )
    row = daily_of(ticks, as_of).first()
    assert row.open_price is None and row.close_price is None and row.price_change_pct is None
    assert (row.total_volume, row.tick_count) == (150, 3)
    assert row.vwap == pytest.approx((11 * 100 + 9 * 50) / 150)


def test_vwap_with_missing_close_keeps_volume_in_the_denominator(make_ticks, as_of):
    ticks = make_ticks([("A", "S", f"{DAY} 02:00:00", 10.0, 10.0, 100), ("A", "S", f"{DAY} 03:00:00", 10.0, None, 100)])
    assert daily_of(ticks, as_of).first().vwap == pytest.approx(5.0)


def test_zero_open_and_zero_volume_give_null(make_ticks, as_of):
    row = daily_of(make_ticks([("A", "S", f"{DAY} 02:00:00", 0.0, 5.0, 0)]), as_of).first()
    assert row.vwap is None and row.price_change_pct is None


def test_tiny_move_is_up_and_flat_and_ratio_without_losers_is_null(make_ticks, as_of):
    ticks = make_ticks([("A", "S", f"{DAY} 02:00:00", 10000.0, 10005.0, 1), ("B", "S", f"{DAY} 02:00:00", 10.0, 11.0, 1)])
    row = models.market_breadth(daily_of(ticks, as_of)).first()
    assert (row.gainers, row.losers, row.flat, row.advance_decline_ratio) == (2, 0, 1, None)


def test_equal_volumes_rank_by_ticker(make_ticks, as_of):
    ticks = make_ticks([(t, "S", f"{DAY} 02:00:00", 1.0, 1.0, 7) for t in "FEDCBAG"])
    top = models.top5_sector_daily(models.ticker_rankings(daily_of(ticks, as_of)))
    assert rows(top, "ticker", "volume_rank") == list(zip("ABCDE", range(1, 6)))


def test_ticker_in_two_sectors_doubles_its_fact_rows(make_ticks, as_of):
    ticks = make_ticks(
        [("A", "S1", f"{DAY} 02:00:00", 1.0, 1.0, 1), ("A", "S2", f"{DAY} 03:00:00", 1.0, 1.0, 1), ("B", "S1", f"{DAY} 03:00:00", 1.0, 1.0, 1)]
    )
    tickers, sectors = models.dimensions(ticks, as_of)
    assert rows(tickers.orderBy("ticker_sk"), "ticker_sk", "ticker_code", "sector") == [(1, "A", "S1"), (2, "A", "S2"), (3, "B", "S1")]
    assert rows(sectors.orderBy("sector_sk"), "sector_sk", "sector_name") == [(1, "S1"), (2, "S2")]
    assert models.fct_intraday_ticks(ticks, tickers, sectors).count() == 5


def test_fact_keeps_ticks_without_dimension_entry(make_ticks, as_of):
    known = make_ticks([("A", "S1", f"{DAY} 02:00:00", 1.0, 1.0, 1)])
    new = make_ticks([("Z", "S9", f"{DAY} 02:00:00", 1.0, 1.0, 1)])
    fact = models.fct_intraday_ticks(new, *models.dimensions(known, as_of))
    assert rows(fact, "ticker_sk", "sector_sk") == [(None, None)]


def test_ticker_names_and_activity(make_ticks, as_of):
    ticks = make_ticks([("BBCA.JK", "Financials", "2024-01-23 02:00:00", 1.0, 1.0, 1), ("BBRI.JK", "Financials", "2024-01-22 02:00:00", 1.0, 1.0, 1)])
    assert rows(models.dim_ticker(ticks, as_of).orderBy("ticker_sk"), "ticker_name", "is_active") == [("Bbca", True), ("Bbri", False)]


def test_sector_categories(make_ticks):
    ticks = make_ticks([("A", s, f"{DAY} 02:00:00", 1.0, 1.0, 1) for s in ("Financials", "Technology", "Energy", "Industrials")])
    expected = {"Financials": "Financial", "Technology": "Infrastructure & Tech", "Energy": "Commodities", "Industrials": "Consumer & Services"}
    assert dict(rows(models.dim_sector(ticks), "sector_name", "sector_category")) == expected


def test_one_trading_day_has_no_anomaly(make_ticks, as_of):
    ticks = make_ticks([("A", "S", "2024-01-29 02:00:00", 1.0, 1.0, 10**6)])
    assert models.volume_anomalies(daily_of(ticks, as_of), as_of).count() == 0


def test_anomaly_is_found_and_banded(make_ticks, as_of):
    volumes = [10, 11, 9, 10, 10, 11, 100]
    ticks = make_ticks([("A", "S", f"2024-01-{23 + i} 02:00:00", 1.0, 1.0, v) for i, v in enumerate(volumes)])
    found = models.anomaly_severity(models.volume_anomalies(daily_of(ticks, as_of), as_of))
    assert rows(found, "ticker", "total_volume", "severity") == [("A", 100, "warning")]
    rolling = extensions.rolling_volume_score(daily_of(ticks, as_of)).filter("total_volume = 100").first()
    assert rolling.volume_z_score > 5


def test_point_lookup(make_ticks):
    ticks = make_ticks([("A", "S", f"{DAY} 0{h}:00:00", 1.0, 1.0, h) for h in range(8)] + [("B", "S", f"{DAY} 09:00:00", 1.0, 1.0, 9)])
    assert rows(reports.ticker_day(ticks, "A", DAY), "volume") == [(7,), (6,), (5,), (4,), (3,)]


def test_silent_periods(spark):
    df = spark.createDataFrame([("t", f"{DAY} 02:0{m}:10") for m in (0, 1)] + [("t", f"{DAY} 02:30:00")], "topic STRING, s STRING")
    gaps = extensions.silent_periods(df.withColumn("ts", F.col("s").cast("timestamp")), "ts")
    assert rows(gaps, "gap_minutes") == [(29,)]


def test_history_of_sector_changes(make_ticks):
    days = ["S1", "S1", "S2", "S2", "S1"]
    ticks = make_ticks([("A", s, f"2024-01-0{i + 1} 02:00:00", 1.0, 1.0, 1) for i, s in enumerate(days)])
    history = extensions.ticker_history(ticks).orderBy("valid_from")
    assert [(r.sector, str(r.valid_from), str(r.valid_to), r.is_current) for r in history.collect()] == [
        ("S1", "2024-01-01", "2024-01-02", False),
        ("S2", "2024-01-03", "2024-01-04", False),
        ("S1", "2024-01-05", "None", True),
    ]


def test_clock_is_used_without_an_instant(make_ticks):
    assert models.staged_ticks(make_ticks([("A", "S", "2000-01-01 00:00:00", 1.0, 1.0, 1)]), AsOf()).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.text("abc", max_size=3)), min_size=1, max_size=50, unique=True))
def test_surrogate_keys_are_consecutive_and_ordered(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "code STRING").repartition(5)
    got = rows(with_surrogate_key(df, "sk", ["code"]).orderBy("sk"), "sk", "code")
    expected = sorted(values, key=lambda v: (v is not None, v or ""))
    assert got == list(enumerate(expected, start=1))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_rank_in_large_groups_equals_a_window(spark, coalesce):
    df = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 101 = 0, NULL, CAST(id % 7 AS STRING))) AS g", "id % 40 AS v", "id"
    )
    order = [F.col("v").desc(), F.col("id").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = with_rank_in_large_groups(df, "r", ["g"], order)
        assert sorted(got.select("id", "r").collect()) == sorted(with_row_number(df, "r", ["g"], order).select("id", "r").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_surrogate_keys_over_many_partitions(spark):
    df = spark.range(20000).select(F.format_string("T%06d", (F.col("id") * 7919) % 20011).alias("code"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = with_surrogate_key(df, "sk", ["code"])
        bad = keyed.join(df.selectExpr("code", "row_number() OVER (ORDER BY code) AS rn"), "code").filter("sk <> rn")
        assert keyed.count() == 20000 and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_broadcast_is_hinted_within_the_bound_only(spark):
    small = spark.range(10)
    assert broadcast_within(small, 10, max_rows=10) is not small
    assert broadcast_within(small, 11, max_rows=10) is small


@pytest.fixture(scope="module")
def daily(spark):
    frame = daily_of(EventTicks(spark, DATA).ticks(), AsOf("2024-01-30 12:00:00")).cache()
    yield frame
    frame.unpersist()


def test_ranks_have_no_gaps(daily):
    ranks = models.sector_daily_summary(daily).groupBy("date_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("sector_performance_rank").alias("p"),
        F.max("sector_performance_rank").alias("pmax"),
        F.max("sector_volume_rank").alias("vmax"),
    )
    assert ranks.filter("n <> p OR n <> pmax OR n <> vmax").count() == 0


def test_sector_volumes_add_up_to_the_market(daily):
    sectors = models.sector_daily_summary(daily).agg(F.sum("sector_total_volume")).first()[0]
    assert sectors == models.market_breadth(daily).agg(F.sum("total_volume")).first()[0]


def test_vwap_lies_between_low_and_high_on_clean_data(make_ticks, as_of):
    ticks = make_ticks([("A", "S", f"{DAY} 0{h}:00:00", 10.0 + h, 11.0 + h, 5 * h + 1) for h in range(9)])
    row = daily_of(ticks, as_of).first()
    assert row.low_price <= row.vwap <= row.high_price


def test_hot_ticker_does_not_change_results(spark, make_ticks, as_of):
    """A third of all rows in one ticker: distributed keys and marks stay exact."""
    base = [("HOT" if i % 3 == 0 else f"T{i % 50:02d}", "S", f"{DAY} {i % 24:02d}:{i % 60:02d}:00", 1.0, 1.0, i) for i in range(3000)]
    ticks = make_ticks(base)
    daily = daily_of(ticks, as_of)
    assert daily.agg(F.sum("total_volume")).first()[0] == sum(r[-1] for r in base)
    assert models.dim_ticker(ticks, as_of).agg(F.max("ticker_sk")).first()[0] == len({r[0] for r in base})


def test_stored_ticks_are_staged_and_pruned(spark, make_ticks, as_of, tmp_path):
    ticks = make_ticks(
        [("A", "S", "2024-01-29 03:00:00", 1.0, 2.0, 10), ("A", "S", "2023-01-01 03:00:00", 1.0, 2.0, 10)]
    )
    path = str(tmp_path / "ticks")
    ticks.withColumn("date_id", F.to_date("timestamp")).write.partitionBy("date_id").parquet(path)
    staged = models.staged_ticks(spark.read.parquet(path), as_of)
    assert staged.columns.count("date_id") == 1
    assert models.daily_stock_stats(staged).count() == 1
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in plan
