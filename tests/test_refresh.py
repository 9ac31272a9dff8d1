"""Incremental loads, kept keys, published versions."""

import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import versions
from tickloom.operators.keys import extend_keys
from tickloom.operators.tables import table_path
from tickloom.plans import models, refresh
from conftest import plan_of

DAYS = ["2024-01-28", "2024-01-29", "2024-01-30"]


def ticks_of(make_ticks, tickers, days=DAYS, volume=10):
    return make_ticks([(t, s, f"{d} 0{h}:00:00", 10.0, 10.0 + h, volume * h) for t, s in tickers for d in days for h in (3, 4)])


FIRST = [("B.JK", "Energy"), ("C.JK", "Technology")]
SECOND = [("A.JK", "Energy"), ("C.JK", "Technology"), ("D.JK", "Banks")]


def keys(spark, root, name, code, key):
    return {r[code]: r[key] for r in refresh.read_table(spark, root, name).collect()}


STAR = {"keys_ticker", "keys_sector", "dim_ticker", "dim_sector", "fct_intraday_ticks"}


def test_keys_survive_later_loads(spark, make_ticks, as_of, tmp_path):
    root = str(tmp_path)
    refresh.refresh(ticks_of(make_ticks, FIRST, DAYS[:2]), root, as_of, STAR, replace="partitions")
    assert keys(spark, root, "dim_ticker", "ticker_code", "ticker_sk") == {"B.JK": 1, "C.JK": 2}
    refresh.refresh(ticks_of(make_ticks, SECOND, DAYS[2:]), root, as_of, STAR, replace="partitions")
    assert keys(spark, root, "dim_ticker", "ticker_code", "ticker_sk") == {"B.JK": 1, "C.JK": 2, "A.JK": 3, "D.JK": 4}
    assert keys(spark, root, "dim_sector", "sector_name", "sector_sk") == {"Energy": 1, "Technology": 2, "Banks": 3}
    spans = {r.ticker_code: (str(r.first_seen_date), str(r.last_seen_date)) for r in refresh.read_table(spark, root, "dim_ticker").collect()}
    assert spans["B.JK"] == (DAYS[0], DAYS[1]) and spans["C.JK"] == (DAYS[0], DAYS[2]) and spans["A.JK"] == (DAYS[2],) * 2
    fact = refresh.read_table(spark, root, "fct_intraday_ticks")
    counted = {r.ticker_sk: r["count"] for r in fact.groupBy("ticker_sk").count().collect()}
    assert counted == {1: 4, 2: 6, 3: 2, 4: 2}
    # A full refresh over other tickers keeps the keys as well.
    refresh.refresh(ticks_of(make_ticks, SECOND), root, as_of, STAR)
    assert keys(spark, root, "dim_ticker", "ticker_code", "ticker_sk") == {"C.JK": 2, "A.JK": 3, "D.JK": 4}


def test_partial_loads_equal_one(spark, make_ticks, as_of, tmp_path):
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    everything = ticks_of(make_ticks, FIRST, DAYS[:2]).unionByName(ticks_of(make_ticks, SECOND, DAYS[1:], 20)).dropDuplicates(["ticker", "timestamp"])
    everything = spark.createDataFrame(everything.collect(), everything.schema)
    # The second day arrives twice: at first without its second hour.
    refresh.refresh(everything.filter("timestamp < TIMESTAMP '2024-01-29 04:00:00'"), parts, as_of, replace="partitions")
    refresh.refresh(everything.filter("timestamp >= TIMESTAMP '2024-01-29 00:00:00'"), parts, as_of, replace="partitions")
    refresh.refresh(everything, whole, as_of)
    for name in ("agg_sector_hourly", "int_daily_stock_stats", "int_sector_daily_summary", "mrt_top5_sector_daily", "mrt_market_breadth", "mrt_volume_anomalies"):
        one, other = (refresh.read_table(spark, root, name) for root in (parts, whole))
        assert sorted(map(str, one.collect())) == sorted(map(str, other.select(*one.columns).collect())), name
    named = {root: refresh.read_table(spark, root, "fct_intraday_ticks").join(refresh.read_table(spark, root, "dim_ticker"), "ticker_sk").drop("ticker_sk", "sector_sk") for root in (parts, whole)}
    assert named[parts].count() == everything.count()
    assert sorted(map(str, named[parts].collect())) == sorted(map(str, named[whole].select(*named[parts].columns).collect()))


def test_emptied_day_leaves_no_old_rows(spark, make_ticks, as_of, tmp_path):
    root = str(tmp_path)
    old = [DAYS[0], "2023-01-05"]
    daily = "int_daily_stock_stats"
    refresh.refresh(ticks_of(make_ticks, FIRST), root, as_of, {daily}, replace="partitions")
    # A day beyond the staging window has no statistics; one within it that no longer qualifies loses them.
    refresh.refresh(ticks_of(make_ticks, FIRST, old), root, as_of, {daily}, replace="partitions")
    assert {str(r.date_id) for r in refresh.read_table(spark, root, daily).select("date_id").distinct().collect()} == set(DAYS)
    empty = refresh.read_table(spark, root, daily).limit(0)
    versions.publish(empty, table_path(root, "intermediate", daily), "date_id", days=[datetime.date(2024, 1, 28)])
    assert {str(r.date_id) for r in refresh.read_table(spark, root, daily).select("date_id").distinct().collect()} == set(DAYS[1:])


def test_any_subset_runs_from_storage(spark, make_ticks, as_of, tmp_path):
    root, ticks = str(tmp_path), ticks_of(make_ticks, FIRST)
    refresh.refresh(ticks, root, as_of)
    for names in ({"fct_intraday_ticks"}, {"mrt_volume_anomalies", "dim_sector"}, {"int_ticker_rankings", "mrt_top5_sector_daily"}):
        status = {r.model: r.status for r in refresh.refresh(ticks, root, as_of, only=names).collect()}
        assert status == {"stg_sector_ticks": "ok", **dict.fromkeys(names, "ok")}
    missing = refresh.refresh(ticks, str(tmp_path / "none"), as_of, only={"fct_intraday_ticks"}).collect()
    assert [r.status for r in missing] == ["ok", "failed"] and "nothing was published" in missing[1].message


def test_failed_model_keeps_its_table_and_skips_those_after_it(spark, make_ticks, as_of, tmp_path):
    root, ticks = str(tmp_path), ticks_of(make_ticks, FIRST)
    refresh.refresh(ticks, root, as_of)
    before = sorted(map(str, refresh.read_table(spark, root, "mrt_top5_sector_daily").collect()))
    status = {r.model: r.status for r in refresh.refresh(ticks.drop("high"), root, as_of).collect()}
    assert status["int_daily_stock_stats"] == "failed" and status["int_ticker_rankings"] == status["mrt_top5_sector_daily"] == "skipped"
    assert status["dim_ticker"] == "ok"
    assert sorted(map(str, refresh.read_table(spark, root, "mrt_top5_sector_daily").collect())) == before


def test_a_write_that_dies_changes_nothing(spark, make_ticks, tmp_path):
    path = str(tmp_path / "t")
    day = lambda df: df.withColumn("date_id", F.to_date("timestamp"))
    versions.publish(day(ticks_of(make_ticks, FIRST)), path, "date_id")
    open_reader = versions.current(spark, path, partition_by="date_id")
    broken = day(ticks_of(make_ticks, SECOND)).withColumn("volume", F.expr("CASE WHEN ticker = 'D.JK' THEN raise_error('lost') ELSE volume END").cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path, "date_id")
    assert versions.state(spark, path).last == 1
    assert versions.current(spark, path, partition_by="date_id").count() == 12
    versions.publish(day(ticks_of(make_ticks, SECOND)), path, "date_id")
    assert versions.current(spark, path, partition_by="date_id").count() == 18
    assert open_reader.count() == 12
    assert versions.drop_superseded(spark, path, keep=0) == [1]
    assert versions.current(spark, path, partition_by="date_id").count() == 18


def test_days_are_read_from_their_last_version(spark, make_ticks, tmp_path):
    path = str(tmp_path / "t")
    day = lambda df: df.withColumn("date_id", F.to_date("timestamp"))
    versions.publish(day(ticks_of(make_ticks, FIRST)), path, "date_id")
    versions.publish(day(ticks_of(make_ticks, SECOND, DAYS[2:])), path, "date_id", days=[datetime.date(2024, 1, 30)])
    versions.publish(day(ticks_of(make_ticks, SECOND, DAYS[1:2])), path, "date_id", days=[datetime.date(2024, 1, 29)])
    table = versions.current(spark, path, partition_by="date_id")
    assert {str(r.date_id): r["count"] for r in table.groupBy("date_id").count().collect()} == {DAYS[0]: 4, DAYS[1]: 6, DAYS[2]: 6}
    text = plan_of(table.filter("date_id = DATE '2024-01-30'"))
    assert "PartitionFilters: [isnotnull(date_id" in text
    assert versions.drop_superseded(spark, path, keep=0) == []


def test_registry_takes_nulls_and_repeated_values(spark):
    rows = lambda values: spark.createDataFrame([(v,) for v in values], "sector STRING")
    one = extend_keys(None, rows(["b", None, "b", "c"]), "k", ["sector"])
    assert {r.sector: r.k for r in one.collect()} == {None: 1, "b": 2, "c": 3}
    two = extend_keys(one, rows(["a", "c", None, "a"]), "k", ["sector"])
    assert {r.sector: r.k for r in two.collect()} == {None: 1, "b": 2, "c": 3, "a": 4}
    assert extend_keys(one, rows([]), "k", ["sector"]).count() == 3
