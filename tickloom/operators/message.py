"""Ticks back to JSON messages with schema headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import iso_offset_string, null_if_nan
from tickloom.schemas import PRICE_COLUMNS, SCHEMA_NAME, SCHEMA_VERSION


def to_messages(ticks: DataFrame) -> DataFrame:
    """(value, headers) rows ready for a topic or file sink; NULLs stay in the JSON."""
    record = F.struct(
        "ticker",
        "sector",
        iso_offset_string(F.col("timestamp")).alias("timestamp"),
        iso_offset_string(F.col("fetch_ts")).alias("fetch_ts"),
        *[null_if_nan(F.col(name).cast("double")).alias(name) for name in PRICE_COLUMNS],
        F.col("volume").try_cast("bigint").alias("volume"),
    )
    headers = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.lit(value).cast("binary").alias("value"))
            for key, value in (("schema_name", SCHEMA_NAME), ("schema_version", SCHEMA_VERSION))
        ]
    )
    return ticks.select(
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
        headers.alias("headers"),
    )


def write_messages(messages: DataFrame, path: str, headers: bool = False) -> None:
    """Append the messages to files: lines of text, or with ``headers`` Parquet rows of value
    and headers, which ``sources.messages.stored_messages`` reads back."""
    if headers:
        messages.select("value", "headers").write.mode("append").parquet(path)
    else:
        messages.select("value").write.mode("append").text(path)


def publish_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Send values and headers to a topic; needs the Kafka package on the class path."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )
