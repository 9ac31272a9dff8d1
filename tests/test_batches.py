"""Tables of micro-batches: packing, in-flight checks, silence, high-water state, supervision."""

import glob
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom.operators import versions
from tickloom.operators.dedup import rising_only
from tickloom.plans import quality
from tickloom.streaming.batches import BatchTable
from tickloom.streaming.flow import run_until_any_stops
from tickloom.streaming.highwater import HighWaterSink
from tickloom.streaming.inflight import InflightQuality
from tickloom.streaming.silence import SilenceWatch, start_silence_watch

SCHEMA = "ticker STRING, timestamp TIMESTAMP, offset BIGINT"
START = datetime(2024, 1, 28)


def batch(spark, number, size=6):
    rows = [(f"T{i % 2}", START + timedelta(hours=2 * number, minutes=i), number * size + i) for i in range(size)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def offsets(frame):
    return sorted(r.offset for r in frame.collect())


def files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def test_files_stay_few_and_rows_stay_equal(spark, tmp_path):
    table = BatchTable(str(tmp_path), "timestamp", ("ticker",), pack_every=4)
    for number in range(22):
        table.write(batch(spark, number), number)
        if number in (3, 9, 21):
            assert offsets(table.read(spark, batch(spark, 0).schema)) == list(range(6 * (number + 1)))
    # At most four batches wait; the days are packed.
    assert len(glob.glob(f"{tmp_path}/batches/*")) <= 5
    packed = versions.current(spark, f"{tmp_path}/packed", "_day")
    assert packed.select("_day").distinct().count() == 2
    assert len(files(f"{tmp_path}/packed/rows")) <= 12


def test_packing_again_after_a_failure_changes_nothing(spark, tmp_path, monkeypatch):
    table, schema = BatchTable(str(tmp_path), "timestamp", pack_every=100), batch(spark, 0).schema
    for number in range(6):
        table.write(batch(spark, number), number)
    table.pack(spark, schema, 3)
    from tickloom.streaming import batches

    monkeypatch.setattr(batches.folders, "delete", lambda *_: None)  # ends before the folders go
    table.pack(spark, schema, 5)
    assert offsets(table.read(spark, schema)) == list(range(36))
    monkeypatch.undo()
    table.pack(spark, schema, 6)
    assert offsets(table.read(spark, schema)) == list(range(36))
    table.write(batch(spark, 6), 6)
    table.write(batch(spark, 6), 6)
    assert offsets(table.read(spark, schema)) == list(range(42))
    missing = spark.createDataFrame([("T", None, 99)], SCHEMA)
    table.write(missing, 7)
    table.pack(spark, schema, 8)
    assert offsets(table.read(spark, schema)) == [*range(42), 99]


def test_pointers_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "POINTER_FILES", 3)
    path = str(tmp_path / "t")
    for number in range(6):
        day = batch(spark, 12 * (number % 3)).withColumn("day", F.to_date("timestamp"))
        versions.publish(day, path, "day", days=[day.first().day])
        versions.drop_superseded(spark, path)
    assert len(files(f"{path}/pointers")) <= 4
    assert versions.state(spark, path).last == 6
    assert versions.current(spark, path, "day").count() == 18


def test_high_water_equals_the_batch_query(spark, tmp_path):
    """Replayed batches, late ticks, more batches than are kept."""
    rows = [("A" if i % 3 else "B", START + timedelta(minutes=(i * 7) % 40 + i // 2), i) for i in range(72)]
    sink = HighWaterSink(str(tmp_path), "offset", full_every=3, pack_every=4)
    for number in range(12):
        part = spark.createDataFrame(rows[6 * number : 6 * number + 6], SCHEMA)
        sink(part, number)
        if number % 5 == 4:
            sink(part, number)
    whole = rising_only(spark.createDataFrame(rows, SCHEMA), "ticker", "offset", "timestamp")
    assert offsets(sink.rows(spark, whole.schema)) == offsets(whole)
    assert len(glob.glob(f"{tmp_path}/marks/*")) <= 6 and len(glob.glob(f"{tmp_path}/rows/batches/*")) <= 5


def test_order_must_be_named(spark, tmp_path):
    with pytest.raises(TypeError):
        HighWaterSink(str(tmp_path))
    with pytest.raises(ValueError, match="arrival"):
        HighWaterSink(str(tmp_path), "nothing")(batch(spark, 0), 0)


def test_forgotten_keys_start_again(spark, tmp_path):
    sink = HighWaterSink(str(tmp_path), "offset", full_every=2, forget_after="1 day")
    rows = [("A", START, 0)], [("B", START + timedelta(days=3), 1)], [("B", START + timedelta(days=4), 2)], [("A", START, 3), ("B", START, 4)]
    for number, some in enumerate(rows):
        sink(spark.createDataFrame(some, SCHEMA), number)
    assert offsets(sink.rows(spark, batch(spark, 0).schema)) == [0, 1, 2, 3]


def test_inflight_log_equals_the_batch_checks(spark, make_ticks, as_of, tmp_path):
    ticks = make_ticks([("A", "Energy", "2024-01-30 03:00:00", 10.0, c, v) for c, v in ((10.0, 5), (-1.0, 5), (None, -3))] + [("B", "Nowhere", "2024-01-30 11:30:00", 1.0, 1.0, 1)])
    written = BatchTable(str(tmp_path / "ticks"), "timestamp")
    sink = InflightQuality(written.write, str(tmp_path / "log"), as_of=as_of)
    sink(ticks, 0)
    sink(ticks, 0)
    sink(ticks.limit(1), 1)
    assert written.read(spark, ticks.schema).count() == 5
    log = sink.rows(spark)
    assert log.groupBy("batch_id").count().orderBy("batch_id").collect() == [("batch-0", 8), ("batch-1", 8)]
    expected = quality.result_log(quality.evaluate(ticks, sink.declared()), as_of, "batch-0", "spark_inflight")
    assert sorted(map(str, log.filter("batch_id = 'batch-0'").collect())) == sorted(map(str, expected.collect()))
    assert log.agg(F.sum("failed_rows")).first()[0] > 0


BEATS = "feed STRING, at TIMESTAMP"


def test_silent_feed_is_reported_once(spark, tmp_path):
    watch = SilenceWatch(str(tmp_path), ("a", "b"), minutes=10)
    at = lambda minutes: START + timedelta(minutes=minutes)
    steps = [
        [("a", at(0)), (None, at(0))],
        [("a", at(8)), (None, at(9))],
        [(None, at(11))],  # b never sent
        [("c", at(15)), (None, at(19))],  # a is silent for 11 minutes
        [(None, at(24))],
        [("a", at(25)), (None, at(25))],
        [(None, at(40))],  # a again, and c
    ]
    for number, rows in enumerate(steps):
        watch(spark.createDataFrame(rows, BEATS), number)
        watch(spark.createDataFrame(rows, BEATS), number)
    minute = lambda t: None if t is None else int((t - START).total_seconds() // 60)
    zoneless = watch.rows(spark).select("feed", F.col("last_seen").cast("timestamp_ntz"), F.col("noticed_at").cast("timestamp_ntz"))
    got = sorted((r[0], minute(r[2]), minute(r[1])) for r in zoneless.collect())
    shift = got[0][1] - 19  # local time zone of the fixture's times
    assert [(f, n - shift, None if s is None else s - shift) for f, n, s in got] == [("a", 19, 8), ("a", 40, 25), ("b", 11, None), ("c", 40, 15)]
    assert len(glob.glob(f"{tmp_path}/seen/*")) == 2


def test_stopped_stream_is_reported_before_its_next_message(spark, tmp_path):
    now = datetime.now()
    source = str(tmp_path / "in")
    spark.createDataFrame([("ticks", now)], "topic STRING, received_ts TIMESTAMP").write.parquet(source)
    messages = spark.readStream.schema("topic STRING, received_ts TIMESTAMP").parquet(source)
    watch = SilenceWatch(str(tmp_path / "watch"), ("ticks", "other"), minutes=0.05)
    running = start_silence_watch(messages, watch, {"processingTime": "1 second"})
    try:
        deadline = time.time() + 90
        while time.time() < deadline and running.isActive:
            time.sleep(2)
            if len(glob.glob(f"{tmp_path}/watch/seen/*")) and {r.feed for r in watch.rows(spark).collect()} == {"ticks", "other"}:
                break
    finally:
        running.stop()
    assert {r.feed for r in watch.rows(spark).collect()} == {"ticks", "other"}


def stream(spark, name, fails):
    def step(frame, number):
        if fails and number > 0:
            raise RuntimeError(f"{name} broke")

    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    return rate.writeStream.queryName(name).foreachBatch(step).trigger(processingTime="200 milliseconds").start()


@pytest.mark.parametrize("broken", ["first", "second"])
def test_failure_of_either_writer_stops_both_and_is_raised(spark, broken):
    queries = [stream(spark, name, name == broken) for name in ("first", "second")]
    with pytest.raises(StreamingQueryException, match=f"{broken} broke"):
        run_until_any_stops(*queries)
    assert not any(q.isActive for q in queries)


def test_end_without_failure_stops_the_other(spark):
    one, two = stream(spark, "one", False), stream(spark, "two", False)
    one.stop()
    run_until_any_stops(one, two)
    assert not two.isActive
