"""Streams over files: split, repeats, late rows, restart, high-water mark, metrics."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators.clean import clean_ticks
from tickloom.operators.message import to_messages, write_messages
from tickloom.operators.parse import parse_messages, schema_version, usable_records
from tickloom.sources.messages import file_messages, file_stream, stored_messages
from tickloom.streaming.batches import BatchTable
from tickloom.streaming.flow import PARSE_METRICS, TICK_METRICS, start_flow, start_packed_flow, tick_flow, to_files, to_topic
from tickloom.streaming.highwater import HighWaterSink, start_high_water
from tickloom.streaming.monitor import PROGRESS_SCHEMA, ProgressLog, progress_frame, recent_progress

DAY = "2024-01-30"


def tick(ticker, time, close=10.0, **extra):
    stamp = f"{DAY}T{time}:00+00:00"
    record = dict(ticker=ticker, sector="Energy", timestamp=stamp, fetch_ts=stamp, open=10.0, high=20.0, low=5.0, close=close, volume=1)
    return json.dumps({**record, **extra})


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.batches = spark, root, 0
        (root / "in").mkdir()

    def put(self, *lines):
        self.batches += 1
        path = self.root / "in" / f"{self.batches:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # Files are taken in the order of their times.
        os.utime(path, (1_700_000_000 + self.batches,) * 2)

    def run(self, salts=8):
        flow = tick_flow(file_stream(self.spark, str(self.root / "in"), max_files=1), salts=salts)
        queries = start_flow(flow, str(self.root / "ticks"), to_files(str(self.root / "rejects")), str(self.root / "cp"))
        for query in queries:
            query.awaitTermination()
        return queries

    def ticks(self):
        frame = self.spark.read.parquet(str(self.root / "ticks"))
        return sorted((r.ticker, r.timestamp.strftime("%H:%M")) for r in frame.select("ticker", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")).collect())

    def rejects(self):
        return sorted(json.loads(r.value)["json_str"] for r in self.spark.read.text(str(self.root / "rejects")).collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_split_and_repeats_across_batches(feed):
    bad_time = tick("A", "02:00", timestamp="never")
    feed.put(tick("A", "02:00"), tick("A", "02:00", 11.0), "{broken", bad_time, tick("", "02:00"))
    feed.put(tick("A", "02:00", 12.0), tick("A", "02:01"), tick("B", "02:00"))
    feed.run()
    assert feed.ticks() == [("A", "02:00"), ("A", "02:01"), ("B", "02:00")]
    assert feed.rejects() == sorted(["{broken", bad_time])


@pytest.mark.parametrize("salts", [1, 8])
def test_late_rows_are_dropped_within_the_watermark_kept(feed, salts):
    feed.put(tick("A", "02:00"))
    feed.put(tick("A", "04:00"))
    # A watermark applies to late rows one batch after the batch that raised it.
    feed.put(tick("A", "04:01"))
    feed.put(tick("B", "02:00"), tick("B", "03:45"))
    ticks, _ = feed.run(salts)
    assert feed.ticks() == [("A", "02:00"), ("A", "04:00"), ("A", "04:01"), ("B", "03:45")]
    dropped = progress_frame(feed.spark, recent_progress(ticks)).agg(F.sum("rows_dropped_by_watermark")).first()[0]
    assert dropped >= 1


def test_restart_resumes_from_the_checkpoint(feed):
    feed.put(tick("A", "02:00"), "{one")
    feed.run()
    feed.put(tick("A", "02:00"), tick("A", "02:10"), "{two")
    feed.run()
    feed.run()
    assert feed.ticks() == [("A", "02:00"), ("A", "02:10")]
    assert feed.rejects() == ["{one", "{two"]


def test_many_copies_of_one_key(feed):
    feed.put(*[tick("A", "02:00", float(i)) for i in range(500)], tick("B", "02:00"))
    feed.run()
    assert feed.ticks() == [("A", "02:00"), ("B", "02:00")]


def test_stream_equals_batch(feed):
    lines = [tick(t, f"02:{m:02d}") for m in range(0, 20) for t in "ABC" for _ in range(1 + m % 2)]
    for i in range(0, len(lines), 25):
        feed.put(*lines[i : i + 25])
    feed.run()
    batch = tick_flow(file_messages(feed.spark, str(feed.root / "in"))).ticks
    assert len(feed.ticks()) == batch.count() == 60


def test_observed_metrics_and_progress_table(feed, tmp_path):
    log = ProgressLog()
    feed.spark.streams.addListener(log)
    try:
        feed.put(tick("A", "02:00", 50.0), tick("B", "02:00", volume=-1), "{broken", tick("C", "02:00", open="x"))
        ticks, _ = feed.run()
        records = recent_progress(ticks)
        deadline = time.time() + 30
        while time.time() < deadline and not {"ticks", "rejects"} <= {r["name"] for r in log.records}:
            time.sleep(0.2)
    finally:
        feed.spark.streams.removeListener(log)
    seen = [r["observedMetrics"] for r in records if r.get("observedMetrics")]
    parse_counts, tick_counts = seen[0][PARSE_METRICS], seen[0][TICK_METRICS]
    assert (parse_counts["messages"], parse_counts["rejected"], parse_counts["partially_corrupt"]) == (4, 1, 1)
    assert (tick_counts["ticks"], tick_counts["ohlcv_logic"], tick_counts["negative_volume"]) == (3, 1, 1)
    assert tick_counts["sectors_covered"] == 1
    table = progress_frame(feed.spark, records)
    assert table.agg(F.sum("input_rows")).first()[0] == 4
    path = str(tmp_path / "progress")
    assert log.flush(feed.spark, path) >= 2
    assert feed.spark.read.schema(PROGRESS_SCHEMA).parquet(path).filter("query_name = 'ticks'").count() >= 1


class DumpFeed:
    """Messages with offsets, as dumped from a topic partition."""

    def __init__(self, spark, root):
        self.spark, self.root, self.next = spark, root, 0

    def put(self, *values):
        rows = [(v, "ticks", 0, self.next + i) for i, v in enumerate(values)]
        self.next += len(values)
        frame = self.spark.createDataFrame(rows, "value STRING, topic STRING, partition INT, offset BIGINT")
        frame.coalesce(1).write.mode("append").parquet(str(self.root / "dump"))

    def stream(self):
        schema = "value STRING, topic STRING, partition INT, offset BIGINT"
        messages = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(self.root / "dump"))
        return clean_ticks(usable_records(parse_messages(messages))).select("ticker", "timestamp", "offset")


def test_high_water_over_batches_and_restart(spark, tmp_path):
    feed = DumpFeed(spark, tmp_path)
    sink = HighWaterSink(str(tmp_path / "hw"), "offset", full_every=2, pack_every=2)
    feed.put(tick("A", "09:30"), tick("A", "09:31"), tick("A", "09:30"))
    feed.put(tick("A", "09:31"), tick("A", "09:33"), tick("A", "09:32"), tick("B", "09:00"))
    start_high_water(feed.stream(), sink).awaitTermination()
    feed.put(tick("B", "09:00"), tick("B", "09:05"), tick("A", "09:33"))
    feed.put(tick("A", "09:34"), tick("C", "08:00"))
    start_high_water(feed.stream(), sink).awaitTermination()
    schema = feed.stream().schema
    got = sorted((r.ticker, r.offset) for r in sink.rows(spark, schema).collect())
    assert got == [("A", 0), ("A", 1), ("A", 4), ("A", 10), ("B", 6), ("B", 8), ("C", 11)]


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    sink = HighWaterSink(str(tmp_path / "hw"), "offset")
    schema = "ticker STRING, timestamp TIMESTAMP, offset BIGINT"
    first = spark.createDataFrame([("A", datetime(2024, 1, 30, 9), 0)], schema)
    second = spark.createDataFrame([("A", datetime(2024, 1, 30, 10), 1), ("A", datetime(2024, 1, 30, 9), 2)], schema)
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)
    assert sorted(r.offset for r in sink.rows(spark, first.schema).collect()) == [0, 1]


def test_dead_letter_topic_options():
    assert to_topic("host:9092", "ticks") == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "ticks_dlq"}


def test_messages_written_to_files_flow_through(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([tick("A", "02:00"), tick("B", "02:00")]))
    ticks = tick_flow(file_messages(spark, str(tmp_path / "in"))).ticks
    write_messages(to_messages(ticks), str(tmp_path / "out"))
    again = tick_flow(file_messages(spark, str(tmp_path / "out"))).ticks
    assert sorted(again.collect()) == sorted(ticks.collect())


def test_headers_stay_with_messages_in_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(tick("A", "02:00"))
    ticks = tick_flow(file_messages(spark, str(tmp_path / "in"))).ticks
    write_messages(to_messages(ticks), str(tmp_path / "out"), headers=True)
    again = stored_messages(spark, str(tmp_path / "out"))
    assert [r.v for r in again.select(schema_version(F.col("headers")).alias("v")).collect()] == ["1"]
    assert sorted(tick_flow(again).ticks.collect()) == sorted(ticks.collect())


def test_packed_flow_keeps_few_files(feed, tmp_path):
    lines = [tick(t, f"02:{m:02d}") for m in range(7) for t in "AB"]
    for i in range(7):
        feed.put(*lines[2 * i : 2 * i + 2], lines[0], "{broken" if i == 3 else lines[1])
    table = BatchTable(str(tmp_path / "packed"), "timestamp", ("ticker",), pack_every=3)
    for _ in range(2):  # the second run resumes and finds nothing new
        flow = tick_flow(file_stream(feed.spark, str(tmp_path / "in"), max_files=1))
        queries = start_packed_flow(flow, table, to_files(str(tmp_path / "rejects")), str(tmp_path / "cp"))
        for query in queries:
            query.awaitTermination()
    stored = table.read(feed.spark, flow.ticks.schema)
    assert sorted((r.ticker, r.timestamp.minute) for r in stored.select("ticker", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")).collect()) == sorted((t, m) for m in range(7) for t in "AB")
    assert len(list((tmp_path / "packed" / "batches").iterdir())) <= 6
