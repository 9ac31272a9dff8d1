"""Table layout, refresh and incremental writes."""

import glob

from pyspark.sql import functions as F

from tickloom.operators.tables import create_table, table_path, write_table
from tickloom.plans import models, quality, refresh
from tickloom.schemas import DQ_RESULT
from tickloom.sources.files import read_candles, with_sector
from tickloom.sources.reference import universe
from conftest import plan_of

DAYS = ("2024-01-28", "2024-01-29", "2024-01-30")


def sample(make_ticks, days=DAYS):
    return make_ticks([(t, s, f"{d} 0{h}:00:00", 10.0, 10.0 + h, 10 * h + i) for d in days for h in range(3, 6) for i, (t, s) in enumerate([("A.JK", "Energy"), ("B.JK", "Energy"), ("C.JK", "Technology")])])


def dated(df):
    return df.withColumn("date_id", F.to_date("timestamp"))


def test_round_trip_and_partition_pruning(spark, make_ticks, tmp_path):
    ticks, path = dated(sample(make_ticks)), str(tmp_path / "ticks")
    assert write_table(ticks, path, "date_id", ["ticker", "sector"], ["timestamp"]) == ticks.count()
    back = spark.read.parquet(path)
    assert sorted(back.select(*ticks.columns).collect()) == sorted(ticks.collect())
    pruned = back.filter(F.col("date_id") == F.lit("2024-01-29").cast("date"))
    assert "PartitionFilters: [isnotnull(date_id" in plan_of(pruned)


def test_rebalanced_layout_keeps_every_row(spark, make_ticks, tmp_path):
    ticks, path = dated(sample(make_ticks)), str(tmp_path / "ticks")
    assert write_table(ticks, path, "date_id", ["ticker"], layout="rebalance") == ticks.count()
    assert sorted(spark.read.parquet(path).select(*ticks.columns).collect()) == sorted(ticks.collect())


def test_hot_day_is_written_by_several_tasks(spark, make_ticks, tmp_path):
    rows = [(f"T{i:04d}", "S", f"2024-01-30 03:{i % 60:02d}:00", 1.0, 1.0, i) for i in range(2000)]
    path = str(tmp_path / "ticks")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(dated(make_ticks(rows)), path, "date_id", ["ticker"], ["timestamp"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{path}/date_id=2024-01-30/*.parquet")) > 1


def test_replace_only_the_days_written(spark, make_ticks, tmp_path):
    path = str(tmp_path / "ticks")
    write_table(dated(sample(make_ticks)), path, "date_id")
    newer = dated(sample(make_ticks, ["2024-01-30"])).limit(2)
    write_table(newer, path, "date_id", replace="partitions")
    left = {str(r.date_id): r["count"] for r in spark.read.parquet(path).groupBy("date_id").count().collect()}
    assert left == {"2024-01-28": 9, "2024-01-29": 9, "2024-01-30": 2}
    write_table(newer, path, "date_id", replace="nothing")
    assert spark.read.parquet(path).count() == 22
    write_table(newer, path, "date_id")
    assert spark.read.parquet(path).count() == 2


def test_create_table_twice(spark, tmp_path):
    path = str(tmp_path / "dq")
    for _ in range(2):
        create_table(spark, "dq_check_results", DQ_RESULT, path, clustered_on=["check_name"])
    assert spark.table("dq_check_results").schema.names == DQ_RESULT.names
    spark.sql("DROP TABLE dq_check_results")


def test_refresh_writes_every_model(spark, make_ticks, as_of, tmp_path):
    ticks, root = sample(make_ticks), str(tmp_path)
    status = {r.model: r for r in refresh.refresh(ticks, root, as_of).collect()}
    assert {r.status for r in status.values()} == {"ok"}, status
    assert list(status) == ["stg_sector_ticks", *[m.name for m in refresh.MODELS]]
    assert status["fct_intraday_ticks"].row_count == ticks.count()
    assert status["int_daily_stock_stats"].row_count == 9
    stored = refresh.read_table(spark, root, "mrt_top5_sector_daily")
    direct = models.top5_sector_daily(models.ticker_rankings(models.daily_stock_stats(models.staged_ticks(ticks, as_of))))
    assert sorted(stored.select(*direct.columns).collect()) == sorted(direct.collect())


def test_refresh_reports_failures_and_goes_on(spark, make_ticks, as_of, tmp_path):
    broken = sample(make_ticks).drop("fetch_ts")
    status = {r.model: r.status for r in refresh.refresh(broken, str(tmp_path), as_of).collect()}
    assert status["fct_intraday_ticks"] == "failed" and status["mrt_market_breadth"] == "ok"


def test_one_day_refresh_replaces_that_day(spark, make_ticks, as_of, tmp_path):
    root = str(tmp_path)
    refresh.refresh(sample(make_ticks), root, as_of)
    day = sample(make_ticks, ["2024-01-30"]).withColumn("volume", F.lit(1).cast("bigint"))
    refresh.refresh(day, root, as_of, only={"int_daily_stock_stats"}, replace="partitions")
    stats = refresh.read_table(spark, root, "int_daily_stock_stats")
    assert stats.count() == 9
    assert stats.filter("date_id = DATE '2024-01-30'").agg(F.sum("total_volume")).first()[0] == 9


def test_quality_log_is_appended(make_ticks, as_of, tmp_path):
    for batch in ("b1", "b2"):
        log = refresh.append_quality_log(sample(make_ticks), str(tmp_path), as_of, batch)
    assert {r.batch_id: r["count"] for r in log.groupBy("batch_id").count().collect()} == {"b1": 8, "b2": 8}
    assert quality.report(log, as_of).count() == 10


def test_candle_files(spark, tmp_path):
    path = str(tmp_path / "candles")
    spark.sql("SELECT 'BBCA.JK' AS ticker, TIMESTAMP '2024-01-30 03:00:00' AS timestamp, double('NaN') AS open, 1.0D AS high, 1.0D AS low, 1.0D AS close, 5L AS volume UNION ALL SELECT 'XXXX.JK', TIMESTAMP '2024-01-30 03:00:00', 1D, 1D, 1D, 1D, 5L").write.parquet(path)
    got = with_sector(read_candles(spark, path), universe(spark)).collect()
    assert [(r.ticker, r.sector, r.open) for r in got] == [("BBCA.JK", "Financials", None)]
    csv = tmp_path / "c.csv"
    csv.write_text("ticker,timestamp,open,high,low,close,volume\nBBRI.JK,2024-01-30T03:00:00Z,1,2,0.5,1.5,7\n")
    row = read_candles(spark, str(csv), "csv").first()
    assert (row.ticker, row.open, row.volume) == ("BBRI.JK", 1.0, 7)
