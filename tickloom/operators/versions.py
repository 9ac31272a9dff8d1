"""Tables published by a pointer: readers see the old rows until a write is complete.

Below a table's folder, ``rows/version=N`` holds what one publication wrote and ``pointers``
says, in one row per publication and replaced day, which version is the current one. A run that
dies half way leaves rows that no pointer names; the next run overwrites them. Frames read
before a publication go on reading the files they were planned with.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.operators import folders
from tickloom.operators.tables import write_table

POINTER_FILES = 20
POINTERS = "version BIGINT, day DATE, whole BOOLEAN, row_count BIGINT, columns STRING"


@dataclass(frozen=True)
class State:
    """Which versions are current: the last whole one (0: none) and the days replaced since."""

    last: int
    whole: int
    replaced: dict[int, list[datetime.date]]
    schema: T.StructType | None

    @property
    def in_use(self) -> list[int]:
        return sorted({*self.replaced, *([self.whole] if self.whole else [])})


def _pointers(spark: SparkSession, path: str) -> DataFrame | None:
    if not folders.exists(spark, f"{path}/pointers"):
        return None
    return spark.read.schema(POINTERS).parquet(f"{path}/pointers")


def state(spark: SparkSession, path: str) -> State:
    """Read the pointers: one small job, one row per day that was ever replaced."""
    pointers = _pointers(spark, path)
    if pointers is None:
        return State(0, 0, {}, None)
    newest = F.struct("version", "columns")
    rows = pointers.groupBy("whole", "day").agg(F.max(newest).alias("m")).select("whole", "day", "m.*").collect()
    whole = max([row["version"] for row in rows if row["whole"]], default=0)
    replaced: dict[int, list[datetime.date]] = {}
    for row in rows:
        if not row["whole"] and row["version"] > whole:
            replaced.setdefault(row["version"], []).append(row["day"])
    last = max(rows, key=lambda row: row["version"])
    return State(last["version"], whole, replaced, T.StructType.fromJson(json.loads(last["columns"])))


def publish(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    layout: str = "range",
    days: Sequence[datetime.date] | None = None,
) -> int:
    """Write ``df`` and make it current; returns its row count.

    ``days``: only these days of the table are replaced. A day without a row in ``df`` is
    empty afterwards; rows of ``df`` on other days stay out of sight. ``None`` replaces
    the whole table. One writer at a time for each table.
    """
    spark = df.sparkSession
    version = state(spark, path).last + 1
    rows = write_table(df, f"{path}/rows/version={version}", partition_by, cluster_by, spread_by, layout=layout)
    columns = df.schema.json()
    if days is None:
        named = [(version, None, True, rows, columns)]
    else:
        named = [(version, day, False, rows, columns) for day in days]
    # One file: it is there or it is not.
    spark.createDataFrame(named, POINTERS).coalesce(1).write.mode("append").parquet(f"{path}/pointers")
    return rows


def current(spark: SparkSession, path: str, partition_by: str | None = None) -> DataFrame:
    """The current rows, with the columns of the last publication."""
    found = state(spark, path)
    if not found.in_use:
        raise FileNotFoundError(f"nothing was published at {path}")
    schema = T.StructType([*found.schema.fields, T.StructField("version", T.LongType())])
    read = [f"{path}/rows/version={v}" for v in found.in_use]
    table = spark.read.option("basePath", f"{path}/rows").schema(schema).parquet(*read)
    version = F.col("version")
    if partition_by is None:
        return table.filter(version == found.last).select(*found.schema.names)
    day = F.col(partition_by)
    replaced = [d for days in found.replaced.values() for d in days]
    # Literals on partition columns: files of other folders are not read.
    seen = version == found.whole
    if replaced:
        seen = seen & (day.isNull() | ~day.isin(replaced))
    for number, days in found.replaced.items():
        seen = seen | ((version == number) & day.isin(days))
    return table.filter(seen).select(*found.schema.names)


def drop_superseded(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Delete the files of versions without a current row, but for the last ``keep``
    publications, which running readers may have open. Returns the versions deleted.

    Pointers are put together in one file as well: it says what they say, so they may all
    be there for a while.
    """
    found, pointers = state(spark, path), _pointers(spark, path)
    if pointers is None:
        return []
    files = [name for name in folders.names(spark, f"{path}/pointers") if name.endswith(".parquet")]
    if len(files) > POINTER_FILES:
        newest = F.max(F.struct("version", "row_count", "columns")).alias("m")
        kept = pointers.groupBy("whole", "day").agg(newest).select("m.version", "day", "whole", "m.row_count", "m.columns")
        kept.filter(F.col("version") >= found.whole).coalesce(1).write.mode("append").parquet(f"{path}/pointers")
        for name in files:
            folders.delete(spark, f"{path}/pointers/{name}")
    written = [int(name.partition("=")[2]) for name in folders.names(spark, f"{path}/rows") if name.startswith("version=")]
    gone = sorted(v for v in written if v not in found.in_use and v <= found.last - keep)
    for version in gone:
        folders.delete(spark, f"{path}/rows/version={version}")
    return gone
