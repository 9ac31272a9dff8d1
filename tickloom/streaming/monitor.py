"""Query health from progress events, as rows of a metrics table."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = """
    query_name STRING, run_id STRING, batch_id BIGINT, progress_ts STRING,
    input_rows BIGINT, input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE,
    batch_duration_ms BIGINT, state_rows BIGINT, rows_dropped_by_watermark BIGINT,
    watermark STRING, observed_metrics STRING
"""


def progress_row(progress: dict) -> tuple:
    """One row of the metrics table from a progress record."""
    operators = progress.get("stateOperators") or []
    return (
        progress.get("name"),
        str(progress.get("runId")),
        progress.get("batchId"),
        progress.get("timestamp"),
        progress.get("numInputRows") or 0,
        _rate(progress.get("inputRowsPerSecond")),
        _rate(progress.get("processedRowsPerSecond")),
        (progress.get("durationMs") or {}).get("triggerExecution"),
        sum(o.get("numRowsTotal", 0) for o in operators),
        sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
        (progress.get("eventTime") or {}).get("watermark"),
        json.dumps(progress.get("observedMetrics") or {}, default=str),
    )


def _rate(value: object) -> float | None:
    return float(value) if isinstance(value, (int, float)) else None


def progress_frame(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    return spark.createDataFrame([progress_row(r) for r in records], PROGRESS_SCHEMA)


def recent_progress(query: StreamingQuery) -> list[dict]:
    return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress]


class ProgressLog(StreamingQueryListener):
    """Keeps every progress record until ``flush`` has appended it to a table."""

    def __init__(self):
        self.records: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.records.append(json.loads(event.progress.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def flush(self, spark: SparkSession, path: str) -> int:
        batch = list(self.records)
        if batch:
            progress_frame(spark, batch).write.mode("append").parquet(path)
            del self.records[: len(batch)]
        return len(batch)
