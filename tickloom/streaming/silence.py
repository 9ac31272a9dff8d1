"""Alarm for feeds that have stopped, before their next message.

A feed that sends nothing starts no computation. Messages are therefore joined by a heartbeat,
a stream of clock ticks, and each micro-batch compares the clock with what every expected feed
sent last. A batch is reduced to one row per feed before anything is kept, so a feed with most
of the messages is no burden.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import folders
from tickloom.streaming.batches import BatchTable

MINUTES = 10
SEEN = "feed STRING, last_seen TIMESTAMP, since TIMESTAMP, alarmed BOOLEAN"
ALERTS = "feed STRING, last_seen TIMESTAMP, noticed_at TIMESTAMP, silent_seconds BIGINT"


def with_heartbeat(messages: DataFrame, heartbeat: DataFrame, feed: str = "topic", time: str = "received_ts") -> DataFrame:
    """``feed, at`` of messages and, with a NULL feed, of the heartbeat's ``timestamp``."""
    beats = heartbeat.select(F.lit(None).cast("string").alias("feed"), F.col("timestamp").alias("at"))
    return messages.select(F.col(feed).cast("string").alias("feed"), F.col(time).alias("at")).unionByName(beats)


@dataclass(frozen=True)
class SilenceWatch:
    """``foreachBatch`` target for ``with_heartbeat`` rows.

    A feed is reported once per silence: when the clock is more than ``minutes`` past its last
    message, or past the start of the watch if it never sent one. Feeds beyond ``expected`` are
    watched from their first message on. Running a batch again changes nothing.
    """

    root: str
    expected: Sequence[str] = ()
    minutes: float = MINUTES

    @property
    def alerts(self) -> BatchTable:
        return BatchTable(f"{self.root}/alerts", "noticed_at", ("feed",))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._state(spark, batch_id - 1)
        latest = batch.groupBy("feed").agg(F.max("at").alias("at"))  # one row per feed
        known = before.select("feed", "last_seen", "since", "alarmed")
        listed = spark.createDataFrame([(name,) for name in self.expected], "feed STRING")
        now = F.lit(latest.agg(F.max("at")).first()[0]).cast("timestamp")
        names = known.select("feed").union(listed).union(latest.filter("feed IS NOT NULL").select("feed")).distinct()
        joined = names.join(known, "feed", "left").join(latest.select("feed", "at"), "feed", "left")
        joined = joined.withColumn("now", now)
        seen = F.greatest("last_seen", "at")
        heard = F.coalesce(F.col("at") > F.coalesce("last_seen", F.lit("1970-01-01").cast("timestamp")), F.lit(False))
        since = F.coalesce("since", "now")
        silent = F.col("now").cast("double") - F.coalesce(seen, since).cast("double")
        late = silent > self.minutes * 60
        after = joined.select(
            "feed",
            seen.alias("last_seen"),
            since.alias("since"),
            F.coalesce(late, F.lit(False)).alias("alarmed"),
            (late & (heard | ~F.coalesce("alarmed", F.lit(False)))).alias("_new"),
            F.col("now").alias("noticed_at"),
            silent.cast("bigint").alias("silent_seconds"),
        )
        path = self._folder(batch_id)
        after.coalesce(1).write.mode("overwrite").parquet(path)
        stored = spark.read.schema(f"{SEEN}, _new BOOLEAN, noticed_at TIMESTAMP, silent_seconds BIGINT").parquet(path)
        self.alerts.write(stored.filter("_new").select("feed", "last_seen", "noticed_at", "silent_seconds"), batch_id)
        for name in folders.names(spark, f"{self.root}/seen"):
            number = int(name.partition("=")[2])
            if number < batch_id - 1:
                folders.delete(spark, self._folder(number))

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/seen/batch_id={batch_id}"

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], SEEN)
        return spark.read.schema(SEEN).parquet(self._folder(batch_id))

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.alerts.read(spark, spark.createDataFrame([], ALERTS).schema)


def start_silence_watch(
    messages: DataFrame, watch: SilenceWatch, trigger: dict | None = None, feed: str = "topic", time: str = "received_ts"
) -> StreamingQuery:
    """Watch a stream of messages with a clock tick a second."""
    beats = messages.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        with_heartbeat(messages, beats, feed, time)
        .writeStream.queryName("silence_watch")
        .foreachBatch(watch)
        .option("checkpointLocation", f"{watch.root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
