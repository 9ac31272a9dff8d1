"""Calendar coverage, reconciliation, catalog tables, newest tick, silence until now."""

import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.asof import AsOf
from tickloom.operators.tables import create_table, write_table, write_to_table
from tickloom.plans import calendar, extensions, models, reconcile, reports
from tickloom.schemas import TICK
from conftest import plan_of

DAYS = ["2024-01-26", "2024-01-29", "2024-01-30"]  # Friday, Monday, Tuesday


def ticks_of(make_ticks, rows):
    return make_ticks([(t, "Energy", f"{d} 0{h}:00:00", 10.0, 11.0, 5 * h) for t, d in rows for h in (3, 4)])


def test_trading_days(spark):
    got = [str(r[0]) for r in calendar.trading_days(spark, "2024-01-25", "2024-01-31", ("2024-01-29",)).orderBy("date_id").collect()]
    assert got == ["2024-01-25", "2024-01-26", "2024-01-30", "2024-01-31"]


def test_coverage_has_every_listed_day(spark, make_ticks):
    days = calendar.trading_days(spark, "2024-01-25", "2024-01-30")
    day = lambda d: datetime.date(2024, 1, d)
    listing = spark.createDataFrame(
        [("A", "Energy", day(1), None), ("B", "Energy", day(26), day(29)), ("C", "Energy", day(30), None), ("D", "Energy", day(31), None), ("E", "Energy", day(1), day(10))],
        "ticker STRING, sector STRING, valid_from DATE, valid_to DATE",
    )
    expected = calendar.listed_days(listing, days)
    ticks = ticks_of(make_ticks, [("A", DAYS[0]), ("B", DAYS[0]), ("X", DAYS[1]), ("A", "2024-01-27"), ("C", DAYS[2])])
    got = {str(r.date_id): tuple(r)[1:] for r in calendar.coverage_by_day(ticks, expected).collect()}
    # Thursday and Monday: every listed ticker failed.
    assert got == {"2024-01-25": (1, 0, 1), DAYS[0]: (2, 2, 0), DAYS[1]: (2, 0, 2), DAYS[2]: (2, 1, 1)}
    missing = {(str(r.date_id), r.ticker) for r in calendar.missing_by_day(ticks, expected).collect()}
    assert missing == {("2024-01-25", "A"), (DAYS[1], "A"), (DAYS[1], "B"), (DAYS[2], "A")}


def test_history_of_tickers_is_a_listing(spark, make_ticks):
    ticks = ticks_of(make_ticks, [("A", DAYS[0]), ("A", DAYS[2])])
    expected = calendar.listed_days(extensions.ticker_history(ticks).select("ticker", "sector", "valid_from", "valid_to"), calendar.trading_days(spark, DAYS[0], DAYS[2]))
    assert [str(r.date_id) for r in calendar.missing_by_day(ticks, expected).collect()] == [DAYS[1]]


def fingerprints(df):
    return reconcile.fingerprint(df, ["ticker", "timestamp", "close", "volume"], F.to_date("timestamp"))


def test_changed_cell_is_found_without_joining_rows(make_ticks):
    ticks = ticks_of(make_ticks, [(t, d) for t in "ABC" for d in DAYS])
    other = ticks.withColumn("volume", F.when((F.col("ticker") == "B") & (F.to_date("timestamp") == F.lit(DAYS[1]).cast("date")) & (F.hour("timestamp") == 4), 0).otherwise(F.col("volume")))
    assert [str(r.date_id) for r in reconcile.differing_days(fingerprints(ticks), fingerprints(other)).collect()] == [DAYS[1]]
    assert reconcile.differing_days(fingerprints(ticks), fingerprints(ticks.repartition(5))).count() == 0
    # A row twice cancels in the xor, not in the sum; a day may be missing as a whole.
    twice = ticks.unionByName(ticks.filter("ticker = 'A'")).unionByName(ticks.filter("ticker = 'A'"))
    assert reconcile.differing_days(fingerprints(ticks), fingerprints(twice)).count() == 3
    gone = ticks.filter(F.to_date("timestamp") != F.lit(DAYS[0]).cast("date"))
    assert [tuple(r)[1:] for r in reconcile.differing_days(fingerprints(ticks), fingerprints(gone)).collect()] == [(6, None)]


def test_fingerprints_scan_once(spark, make_ticks, tmp_path):
    ticks_of(make_ticks, [("A", DAYS[0])]).write.parquet(str(tmp_path / "t"))
    text = plan_of(fingerprints(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("FileScan") == 1 and "fetch_ts" not in text


def test_key_integrity_both_ways(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "ticker_sk BIGINT")
    dimension = spark.createDataFrame([(1,), (2,), (3,), (4,)], "ticker_sk BIGINT")
    assert tuple(reconcile.key_integrity(fact, dimension, "ticker_sk").first()) == (1, 1, 1, 2)
    assert tuple(reconcile.key_integrity(fact.limit(0), dimension.limit(0), "ticker_sk").first()) == (0, 0, 0, 0)


@pytest.fixture
def catalog_tables(spark, tmp_path):
    names = ["facts", "facts2", "dims"]
    yield names, tmp_path
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows_in(df):
    return sorted(map(str, df.collect()))


def test_catalog_shows_what_was_written(spark, make_ticks, catalog_tables):
    _, root = catalog_tables
    dated = ticks_of(make_ticks, [(t, d) for t in "AB" for d in DAYS]).withColumn("date_id", F.to_date("timestamp"))
    create_table(spark, "facts", dated.schema, str(root / "facts"), "date_id", ["ticker", "timestamp"])
    shown = lambda: rows_in(spark.table("facts").select(*dated.columns))
    files = lambda: rows_in(spark.read.schema(dated.schema).parquet(str(root / "facts")).select(*dated.columns))
    write_to_table(dated, "facts")
    assert shown() == rows_in(dated) == files()
    assert "PartitionFilters: [isnotnull(date_id" in plan_of(spark.table("facts").filter("date_id = DATE '2024-01-30'"))
    later = dated.filter("date_id = DATE '2024-01-30' AND ticker = 'A'")
    write_to_table(later, "facts", "partitions", [datetime.date(2024, 1, 29), datetime.date(2024, 1, 30)])
    assert shown() == rows_in(dated.filter("date_id = DATE '2024-01-26'").unionByName(later))
    write_to_table(later, "facts", "nothing")
    assert spark.table("facts").count() == 4 + 2 * 2
    write_to_table(dated.limit(0), "facts", "partitions", [datetime.date(2024, 1, 30)])
    assert spark.table("facts").count() == 4
    write_to_table(dated.limit(0), "facts")
    assert shown() == [] == files()


def test_bucketed_tables_join_without_exchange(spark, catalog_tables):
    _, root = catalog_tables
    fact = spark.range(3000).selectExpr("id % 50 AS ticker_sk", "date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS date_id", "id AS volume").select("ticker_sk", "volume", "date_id")
    dimension = spark.range(50).selectExpr("id AS ticker_sk", "concat('T', id) AS ticker_code")
    for name, frame, day in (("facts", fact, "date_id"), ("facts2", fact, "date_id"), ("dims", dimension, None)):
        create_table(spark, name, frame.schema, str(root / name), day, ["ticker_sk"], bucket_by="ticker_sk", buckets=4)
        write_to_table(frame, name)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = spark.table("facts").join(spark.table("dims"), "ticker_sk")
        totals = [spark.table(n).groupBy("ticker_sk").agg(F.sum("volume").alias(n)) for n in ("facts", "facts2")]
        both = totals[0].join(totals[1], "ticker_sk")
        assert "Exchange" not in plan_of(star) and "SortMergeJoin" in plan_of(star)
        assert "Exchange" not in plan_of(both)
        assert star.count() == 3000 and both.filter("facts = facts2").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_newest_tick_opens_the_last_day_only(spark, make_ticks, tmp_path):
    path = str(tmp_path / "ticks")
    ticks = ticks_of(make_ticks, [("A", d) for d in [*DAYS, "2024-02-02"]]).select(*TICK.names)
    write_table(ticks.withColumn("date_id", F.to_date("timestamp")), path, "date_id")
    as_of = AsOf("2024-01-31 12:00:00")
    part = reports.newest_day(spark, path, as_of)
    result = reports.freshness(part, as_of)
    assert tuple(result.first()) == tuple(reports.freshness(ticks, as_of).first())
    text = plan_of(result)
    assert "2024-01-30" in text[text.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "close" not in text[text.index("ReadSchema") :].split("\n")[0]
    assert tuple(reports.freshness(reports.newest_day(spark, path, AsOf("2024-01-01 00:00:00")), as_of).first()) == (None, None, False, False)


def test_recent_part_widens_until_a_tick_is_found(spark, make_ticks):
    ticks = ticks_of(make_ticks, [("A", DAYS[0])])
    asked = []

    def read(since):
        asked.append(since)
        return ticks if since is None else ticks.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))

    for instant, reads in (("2024-01-26 12:00:00", 1), ("2024-01-30 12:00:00", 2), ("2024-06-30 12:00:00", 3)):
        asked.clear()
        as_of = AsOf(instant)
        assert tuple(reports.freshness(reports.recent_part(read, as_of), as_of).first()) == tuple(reports.freshness(ticks, as_of).first())
        assert len(asked) == reads


def test_gap_until_now(spark):
    at = lambda m: datetime.datetime(2024, 1, 30, 9, m)
    rows = spark.createDataFrame([("a", at(0)), ("a", at(20)), ("b", at(55))], "topic STRING, at TIMESTAMP")
    now = str(spark.createDataFrame([(at(59),)], "t TIMESTAMP").select(F.col("t").cast("timestamp_ntz")).first()[0])
    got = sorted((r.topic, r.next_minute is None, r.gap_minutes) for r in extensions.silent_periods(rows, "at", as_of=AsOf(now)).collect())
    assert got == [("a", False, 20), ("a", True, 39)]


@pytest.mark.parametrize("z, band", [(2.0, None), (2.5, "warning"), (3.0, "warning"), (3.5, "critical"), (5.0, "critical"), (5.1, "investigate"), (None, None)])
def test_severity_bands(spark, z, band):
    frame = spark.createDataFrame([(z,)], "volume_z_score DOUBLE")
    assert models.anomaly_severity(frame).first().severity == band
