"""Message sources: a topic, or files holding one JSON record per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def topic_stream(
    spark: SparkSession, servers: str, topic: str, options: dict | None = None
) -> DataFrame:
    """Stream of a message topic. Needs the Kafka package on the class path.

    ``latest`` applies to the first start only; later starts resume from the
    checkpoint.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .option("includeHeaders", "true")
        .options(**(options or {}))
        .load()
    )


def file_stream(
    spark: SparkSession, path: str, topic: str = "ticks", max_files: int | None = None
) -> DataFrame:
    """The same message shape from a folder of text files.

    A file has no offsets, so a hash of file and payload stands in for them: it is
    only used to spread and to trace records, never to order them.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _as_messages(reader.load(path), topic)


def file_messages(spark: SparkSession, path: str, topic: str = "ticks") -> DataFrame:
    return _as_messages(spark.read.text(path), topic)


def stored_messages(spark: SparkSession, path: str, topic: str = "ticks") -> DataFrame:
    """Messages written with their headers, in the same shape."""
    kind = "value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
    rows = spark.read.schema(kind).parquet(path)
    return rows.select(*_coordinates(topic), "headers")


def _as_messages(lines: DataFrame, topic: str) -> DataFrame:
    return lines.select(*_coordinates(topic))


def _coordinates(topic: str) -> list[Column]:
    place = F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "value")
    return [F.col("value"), F.lit(topic).alias("topic"), F.lit(0).alias("partition"), place.alias("offset")]
