"""Checks and their log."""

import json

from pyspark.sql import functions as F

from tickloom.plans import quality, reports
from tickloom.schemas import DQ_RESULT
from tickloom.sources.reference import ACCEPTED_SECTORS, universe
from conftest import plan_of

DAY = "2024-01-30"


def counts(df):
    return {r.check_id: (r.total_rows, r.failed_rows) for r in df.collect()}


def test_tick_checks(make_ticks, as_of):
    ticks = make_ticks(
        [
            ("A", "Energy", f"{DAY} 11:30:00", 10.0, 10.0, 5),
            ("B", "Energy", f"{DAY} 11:30:00", 10.0, 10.0, -5),
            (None, "Energy", f"{DAY} 10:00:00", 10.0, 10.0, None),
            ("A", "Energy", "2024-01-29 10:00:00", 10.0, 10.0, -5),
            (None, "Energy", None, 10.0, 10.0, 5),
        ]
    )
    result = quality.evaluate(ticks, [*quality.tick_checks(as_of), quality.missing_keys()])
    assert counts(result) == {
        "ohlcv_logic": (3, 0),
        "negative_volume": (3, 1),
        "null_critical_fields": (3, 1),
        "stale_data": (3, 1),
        "null_critical_fields_all": (5, 2),
    }


def test_price_tolerance(spark, as_of):
    df = spark.createDataFrame([(100.0, 110.0, c) for c in (99.95, 99.8, 110.1, 110.2, 105.0)], "low DOUBLE, high DOUBLE, close DOUBLE")
    failed = df.filter(quality.price_logic()).collect()
    assert [r.close for r in failed] == [99.8, 110.2]


def test_null_value_is_no_expression_failure(make_ticks):
    ticks = make_ticks([("A", "Energy", f"{DAY} 02:00:00", 1.0, None, None)])
    assert counts(quality.evaluate(ticks, quality.expression_checks())) == {"close_positive": (1, 0), "volume_nonneg": (1, 0)}


def test_empty_input_has_null_rate(make_ticks, as_of):
    result = quality.evaluate(make_ticks([]), quality.tick_checks(as_of)).collect()
    assert [r.failure_rate for r in result] == [None] * 4


def test_all_checks_share_one_scan(make_ticks, as_of, spark, tmp_path):
    path = str(tmp_path / "ticks")
    make_ticks([("A", "Energy", f"{DAY} 02:00:00", 1.0, 1.0, 1)]).write.parquet(path)
    checks = [*quality.tick_checks(as_of), quality.missing_keys(), *quality.expression_checks(), quality.accepted_sector_check()]
    log = quality.result_log(quality.evaluate(spark.read.parquet(path), checks), as_of, "b1")
    assert plan_of(log).count("FileScan") == 1
    assert log.schema.names == DQ_RESULT.names
    assert [f.dataType for f in log.schema.fields] == [f.dataType for f in DQ_RESULT.fields]
    first = log.first()
    assert json.loads(first.details) == {"failed_rows": 0, "total_rows": 1}


def test_unknown_sector_is_reported(make_ticks):
    ticks = make_ticks([("A", s, f"{DAY} 02:00:00", 1.0, 1.0, 1) for s in ("Energy", "Industrials", None)])
    assert [tuple(r) for r in quality.unexpected_values(ticks, "sector", ACCEPTED_SECTORS).collect()] == [("Industrials", 1)]


def test_coverage(spark, make_ticks):
    listed = universe(spark, {"Energy": ["A", "B"], "Technology": ["C"]})
    ticks = make_ticks([("A", "Energy", f"{DAY} 02:00:00", 1.0, 1.0, 1), ("X", "Energy", f"{DAY} 02:00:00", 1.0, 1.0, 1)])
    got = {r.sector: (r.expected_tickers, r.observed_tickers, r.missing_tickers) for r in quality.sector_coverage(ticks, listed).collect()}
    assert got == {"Energy": (2, 1, 1), "Technology": (1, 0, 1)}
    assert sorted(r.ticker for r in quality.missing_tickers(ticks, listed).collect()) == ["B", "C"]
    assert [(r.tickers_succeeded, r.tickers_failed) for r in quality.ticker_coverage(ticks, listed).collect()] == [(1, 2)]


def test_repeated_keys(make_ticks):
    ticks = make_ticks([("A", "S", f"{DAY} 02:00:00", 1.0, 1.0, v) for v in (1, 2)] + [("B", "S", f"{DAY} 02:00:00", 1.0, 1.0, 1)])
    assert [(r.ticker, r.copies) for r in quality.repeated_keys(ticks).collect()] == [("A", 2)]


def test_freshness(make_ticks, as_of):
    fresh = reports.freshness(make_ticks([("A", "S", f"{DAY} 11:55:00", 1.0, 1.0, 1), ("A", "S", f"{DAY} 13:00:00", 1.0, 1.0, 1)]), as_of).first()
    assert (fresh.age_seconds, fresh.gate_open, fresh.too_old) == (300, True, False)
    old = reports.freshness(make_ticks([("A", "S", "2024-01-29 12:00:00", 1.0, 1.0, 1)]), as_of).first()
    assert (old.age_seconds, old.gate_open, old.too_old) == (86400, False, True)
    none = reports.freshness(make_ticks([]), as_of).first()
    assert (none.latest_ts, none.gate_open, none.too_old) == (None, False, False)


def test_report_takes_todays_worst(spark, as_of):
    log = spark.createDataFrame([(f"c{i:02d}", i, i / 100) for i in range(12)] , "check_name STRING, failed_rows BIGINT, failure_rate DOUBLE")
    log = log.withColumn("execution_ts", as_of.now).unionByName(
        spark.createDataFrame([("old", 9, 0.99)], "check_name STRING, failed_rows BIGINT, failure_rate DOUBLE").withColumn("execution_ts", as_of.days_before_now(1))
    )
    assert [r.check_name for r in quality.report(log, as_of).collect()] == [f"c{i:02d}" for i in range(11, 1, -1)]


def test_trend(spark):
    df = spark.createDataFrame(
        [(d, c, 1, r) for c, rates in {"a": (0.1, 0.2), "b": (0.3, 0.3), "c": (0.2, 0.1), "d": (0.0, 0.0)}.items() for d, r in zip(("2024-01-01", "2024-01-02"), rates)],
        "date_id STRING, check_id STRING, failed_rows BIGINT, failure_rate DOUBLE",
    ).withColumn("date_id", F.to_date("date_id"))
    second = quality.daily_trend(df).filter("date_id = DATE '2024-01-02'").orderBy("failure_rank")
    assert [(r.check_id, r.trend) for r in second.collect()] == [("b", "same"), ("a", "up"), ("c", "down")]
