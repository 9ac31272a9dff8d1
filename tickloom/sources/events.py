"""Tick relations derived from the ``events`` table.

The given tables hold no stock ticks. This adapter maps every event to one tick
record with narrow expressions only and plants the cases the operators must
handle: NULL and empty tickers, NaN opens, NULL closes and volumes, negative
volumes, closes above the high, repeated (ticker, timestamp) pairs, truncated and
empty payloads, unknown fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.functions import TICKER_SUFFIX, iso_offset_string
from tickloom.operators.clean import drop_bad_keys, nan_to_null
from tickloom.operators.dedup import first_per_key
from tickloom.schemas import TICK_COLUMNS

# Sector of a user id by its remainder modulo eleven.
SECTORS = [
    "Energy",
    "Basic Materials",
    "Industrials",
    "Consumer Non-Cyclicals",
    "Consumer Cyclicals",
    "Healthcare",
    "Financials",
    "Properties & Real Estate",
    "Technology",
    "Infrastructures",
    "Transportation & Logistic",
]
_SECTOR_LITERALS = ", ".join(f"'{sector}'" for sector in SECTORS)
_NUMBER = "TRY_CAST(get_json_object(props, '$.k') AS BIGINT)"
# File schemas by path: read from the footer once, not by every query.
_SCHEMAS: dict[str, StructType] = {}
TOPIC = "ticks"
TRUNCATED_LENGTH = 20
# Arrival order: ids are shuffled inside blocks of this many consecutive events.
ARRIVAL_BLOCK = 1024
ARRIVAL_STEP = 389


def fixture_universe() -> dict[str, list[str]]:
    """Five tickers per sector: the ids 0-54, sector by remainder."""
    return {
        sector: [f"U{number:06d}.JK" for number in range(i, 55, len(SECTORS))]
        for i, sector in enumerate(SECTORS)
    }


def arrival_order() -> Column:
    """A unique arrival number that lets rows overtake each other within a block."""
    within = F.col("event_id") % ARRIVAL_BLOCK
    return F.col("event_id") - within + (within * ARRIVAL_STEP) % ARRIVAL_BLOCK


class EventTicks:
    """Tick relations over one data folder.

    ``since`` / ``until`` are implied by a later filter on the tick time (the hour
    of the event) and only exist to reach the scan: an event of an hour at or after
    ``since`` is itself at or after ``since``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def events(self, since: str | None = None, until: str | None = None) -> DataFrame:
        path = f"{self.folder}/events.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        events = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        kind = _SCHEMAS[path]["ts"].dataType.simpleString()
        if since:
            events = events.filter(f"ts >= CAST('{since}' AS {kind})")
        if until:
            events = events.filter(f"ts < CAST('{until}' AS {kind})")
        return events

    def raw(self, since: str | None = None, until: str | None = None) -> DataFrame:
        return self.events(since, until).selectExpr(
            "event_id",
            "user_id",
            f"""CASE WHEN event_id % 211 = 7 THEN NULL WHEN event_id % 223 = 7 THEN ''
                ELSE concat('U', lpad(CAST(user_id AS STRING), 6, '0'), '{TICKER_SUFFIX}')
                END AS ticker""",
            f"element_at(array({_SECTOR_LITERALS}), CAST(user_id % 11 + 1 AS INT)) AS sector",
            "date_trunc('HOUR', CAST(ts AS TIMESTAMP)) AS timestamp",
            "CAST(ts AS TIMESTAMP) AS fetch_ts",
            "CASE WHEN event_id % 101 = 7 THEN double('NaN') ELSE value END AS open",
            "value * 1.02D AS high",
            "value * 0.98D AS low",
            """CASE WHEN event_id % 131 = 7 THEN NULL
                WHEN event_id % 97 = 7 THEN value * 1.05D
                ELSE value * (1D + CAST(event_id % 21 - 10 AS DOUBLE) / 1000D) END AS close""",
            f"""CASE WHEN event_id % 127 = 7 THEN NULL
                WHEN event_id % 113 = 7 THEN -{_NUMBER} - 1 ELSE {_NUMBER} END AS volume""",
        )

    def clean(self, since: str | None = None, until: str | None = None) -> DataFrame:
        return nan_to_null(drop_bad_keys(self.raw(since, until)))

    def ticks(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """The tick table: cleaned rows, first of each (ticker, timestamp)."""
        unique = first_per_key(
            self.clean(since, until), ["ticker", "timestamp"], ["fetch_ts", "event_id"]
        )
        return unique.select(*TICK_COLUMNS)

    def messages(self) -> DataFrame:
        """The raw records as JSON messages, some of them broken."""
        record = F.struct(
            "ticker",
            "sector",
            iso_offset_string(F.col("timestamp")).alias("timestamp"),
            iso_offset_string(F.col("fetch_ts")).alias("fetch_ts"),
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
        payload = f"""CASE WHEN event_id % 89 = 7 THEN substring(text, 1, {TRUNCATED_LENGTH})
            WHEN event_id % 179 = 7 THEN ''
            WHEN event_id % 83 = 7
              THEN concat(substring(text, 1, length(text) - 1), ',"bid":1.5}}')
            ELSE text END AS value"""
        return (
            self.raw()
            .select("event_id", "user_id", "fetch_ts", F.to_json(record).alias("text"))
            .selectExpr(
                payload,
                f"'{TOPIC}' AS topic",
                "CAST(user_id % 4 AS INT) AS partition",
                "event_id AS offset",
                "fetch_ts AS received_ts",
            )
        )
