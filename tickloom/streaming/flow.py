"""The ingest flow: messages in, clean de-duplicated ticks and dead letters out.

``tick_flow`` is a function on DataFrames, so the same code runs on a batch of
messages and on a stream. Where the messages come from and where the results go is
up to the caller; ``start_flow`` writes files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.clean import clean_ticks
from tickloom.operators.parse import (
    as_dead_letters,
    parse_messages,
    rejected_messages,
    usable_records,
)
from tickloom.plans.quality import price_logic
from tickloom.schemas import TICK_COLUMNS
from tickloom.sources.reference import SECTOR_TICKERS
from tickloom.streaming.batches import BatchTable

WATERMARK = "30 minutes"
# Copies of one key are spread over this many tasks before they meet.
SALTS = 8
PARSE_METRICS = "parse_quality"
TICK_METRICS = "tick_quality"


@dataclass(frozen=True)
class Flow:
    ticks: DataFrame
    rejects: DataFrame


def tick_flow(
    messages: DataFrame,
    watermark: str = WATERMARK,
    salts: int = SALTS,
    sectors: list[str] | None = None,
) -> Flow:
    """Split, clean and de-duplicate ``messages`` (value, topic, partition, offset).

    Messages that are malformed or have no event time go to ``rejects``: a NULL time
    would pass every watermark and its de-duplication state would never be dropped.
    Quality counts are attached to both steps as observed metrics.
    """
    parsed = parse_messages(messages).observe(PARSE_METRICS, *parse_metrics())
    usable = clean_ticks(usable_records(parsed)).observe(TICK_METRICS, *tick_metrics(sectors))
    unique = drop_repeats(usable, watermark, salts).select(*TICK_COLUMNS)
    rejects = as_dead_letters(rejected_messages(parse_messages(messages)))
    return Flow(unique, rejects)


def drop_repeats(
    ticks: DataFrame, watermark: str = WATERMARK, salts: int = SALTS, spread: str = "offset"
) -> DataFrame:
    """First of each (ticker, timestamp) under an event-time watermark.

    A de-duplication sends all copies of a key to one task. With ``salts`` > 1 a first
    pass removes copies per (key, salt), so that at most ``salts`` rows of a key and
    batch reach the second pass, however many copies arrived. Both passes forget keys
    older than the watermark.
    """
    marked = ticks.withWatermark("timestamp", watermark)
    if salts > 1:
        salted = marked.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
        marked = salted.dropDuplicates(["ticker", "timestamp", "_salt"]).drop("_salt")
    return marked.dropDuplicates(["ticker", "timestamp"])


def parse_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        F.count_if("partially_corrupt").alias("partially_corrupt"),
        F.count_if(
            F.col("reject_reason").isNull() & (F.coalesce(F.col("ticker"), F.lit("")) == "")
        ).alias("missing_ticker"),
    ]


def tick_metrics(sectors: list[str] | None = None) -> list[Column]:
    """In-stream checks as one aggregate row; sector coverage is one flag per listed
    sector, so its size does not depend on the data.
    """
    expected = list(SECTOR_TICKERS) if sectors is None else sectors
    covered = sum(
        (F.max(F.coalesce(F.col("sector") == s, F.lit(False)).cast("int")) for s in expected),
        start=F.lit(0),
    )
    stale = F.col("timestamp") < F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return [
        F.count(F.lit(1)).alias("ticks"),
        F.count_if(price_logic()).alias("ohlcv_logic"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.count_if(stale).alias("stale_data"),
        F.count_if(F.col("sector").isNull() | F.col("close").isNull()).alias("null_fields"),
        F.coalesce(covered, F.lit(0)).alias("sectors_covered"),
        F.max("timestamp").alias("latest_ts"),
    ]


def start_flow(
    flow: Flow,
    ticks_path: str,
    rejects_sink: dict[str, str],
    checkpoint_path: str,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both writers, each with its own checkpoint.

    ``rejects_sink`` comes from ``to_files`` or ``to_topic``. File sink and checkpoint
    together write every accepted tick exactly once. The number of state partitions is
    fixed by ``spark.sql.shuffle.partitions`` at the first start.
    """
    trigger = trigger or {"availableNow": True}
    dated = flow.ticks.withColumn("date_id", F.to_date("timestamp"))
    ticks = (
        dated.writeStream.queryName("ticks")
        .format("parquet")
        .partitionBy("date_id")
        .option("path", ticks_path)
        .option("checkpointLocation", f"{checkpoint_path}/ticks")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
    return ticks, _start_rejects(flow, rejects_sink, checkpoint_path, trigger)


def start_packed_flow(
    flow: Flow,
    ticks: BatchTable,
    rejects_sink: dict[str, str],
    checkpoint_path: str,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Like ``start_flow``, with the ticks in a table whose files are packed by day.

    A batch overwrites what an earlier run of it left, so every accepted tick is stored once.
    """
    trigger = trigger or {"availableNow": True}
    accepted = (
        flow.ticks.writeStream.queryName("ticks")
        .foreachBatch(ticks.write)
        .option("checkpointLocation", f"{checkpoint_path}/ticks")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
    return accepted, _start_rejects(flow, rejects_sink, checkpoint_path, trigger)


def _start_rejects(flow: Flow, sink: dict[str, str], checkpoint_path: str, trigger: dict) -> StreamingQuery:
    options = dict(sink)
    return (
        flow.rejects.writeStream.queryName("rejects")
        .format(options.pop("format"))
        .options(**options)
        .option("checkpointLocation", f"{checkpoint_path}/rejects")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def to_files(path: str) -> dict[str, str]:
    """Dead letters as lines of text files."""
    return {"format": "text", "path": path}


def to_topic(servers: str, topic: str) -> dict[str, str]:
    """Dead letters to the topic's dead-letter topic; needs the Kafka package."""
    return {"format": "kafka", "kafka.bootstrap.servers": servers, "topic": f"{topic}_dlq"}


def run_until_any_stops(*queries: StreamingQuery, poll_seconds: int = 1) -> None:
    """Block until any of the writers ends, stop the others, raise the error of one that failed.

    The session's stream manager wakes the caller; it also reports streams that are not
    among ``queries``, which are left alone.
    """
    streams = SparkSession.active().streams
    try:
        while all(query.isActive for query in queries):
            try:
                streams.awaitAnyTermination(poll_seconds)
            except StreamingQueryException:
                pass  # whose it is shows below
            streams.resetTerminated()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        error = query.exception()
        if error is not None:
            raise error
