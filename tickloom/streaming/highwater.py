"""Keyed high-water mark over micro-batches.

The feed re-sends whole days; a tick counts as new only if it is later than every
tick of its ticker seen before. Each micro-batch is an ordinary batch job on
built-in operators: compare with the stored marks, apply the running maximum inside
the batch, write. A hot ticker is split by the batch operator instead of feeding one
keyed state process.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampType

from tickloom.operators import folders
from tickloom.operators.dedup import high_water, rising_only
from tickloom.streaming.batches import PACK_EVERY, BatchTable

FULL_EVERY = 20


@dataclass(frozen=True)
class HighWaterSink:
    """``foreachBatch`` target writing new rows and marks under ``root``.

    ``order`` names the column that numbers the rows of a key in order of arrival, such as
    the offset of a topic partition; a hash of a file's lines is no such column.

    Every batch owns the folders of its id and overwrites them, so a batch that is
    run again after a failure leaves the same result. Marks are stored as changes,
    and every ``full_every`` batches as a whole; older ones are deleted then, except what
    the batch itself was computed from. Rows are packed by day every ``pack_every`` batches.
    ``forget_after`` (an interval such as ``"30 days"``) drops the marks of keys that have
    been silent for so long at the next whole set; a tick re-sent after that is new again.
    ``root`` belongs to one stream checkpoint.
    """

    root: str
    order: str
    key: str = "ticker"
    time: str = "timestamp"
    full_every: int = FULL_EVERY
    pack_every: int = PACK_EVERY
    forget_after: str | None = None

    @property
    def accepted(self) -> BatchTable:
        return BatchTable(f"{self.root}/rows", self.time, (self.key,), self.pack_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.order not in batch.columns:
            raise ValueError(f"no column {self.order!r} that tells the order of arrival")
        spark = batch.sparkSession
        known = self.marks_before(spark, batch_id, batch.schema[self.key].dataType)
        fresh = rising_only(batch, self.key, self.order, self.time, known)
        self.accepted.write(fresh, batch_id)

        written = spark.read.schema(batch.schema).parquet(self.accepted.folder(batch_id))
        marks = high_water(written, self.key, self.time)
        whole = batch_id % self.full_every == 0
        if whole:
            marks = marks.unionByName(known).groupBy(self.key).agg(F.max("high_water").alias("high_water"))
            marks = self._lively(marks)
        marks.write.mode("overwrite").parquet(self._marks(batch_id))
        if whole:
            first_needed = self._last_full(batch_id)
            for name in folders.names(spark, f"{self.root}/marks"):
                number = int(name.partition("=")[2])
                if number < first_needed:
                    folders.delete(spark, self._marks(number))

    def _lively(self, marks: DataFrame) -> DataFrame:
        if self.forget_after is None:
            return marks
        newest = marks.agg(F.max("high_water")).first()[0]
        if newest is None:
            return marks
        return marks.filter(F.col("high_water") >= F.lit(newest) - F.expr(f"INTERVAL {self.forget_after}"))

    def _marks(self, batch_id: int) -> str:
        return f"{self.root}/marks/batch_id={batch_id}"

    def _last_full(self, batch_id: int) -> int:
        """The last whole set that ``batch_id`` is compared with."""
        return max(0, (batch_id - 1) // self.full_every * self.full_every)

    def marks_before(
        self, spark: SparkSession, batch_id: int, key_type: DataType = StringType()
    ) -> DataFrame:
        """Marks reached before ``batch_id``: the last whole set and the changes since."""
        schema = StructType(
            [StructField(self.key, key_type), StructField("high_water", TimestampType())]
        )
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        stored = [self._marks(i) for i in range(self._last_full(batch_id), batch_id)]
        marks = spark.read.schema(schema).parquet(*stored)
        return marks.groupBy(self.key).agg(F.max("high_water").alias("high_water"))

    def rows(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """Everything accepted so far."""
        return self.accepted.read(spark, schema)


def start_high_water(
    rows: DataFrame, sink: HighWaterSink, trigger: dict | None = None
) -> StreamingQuery:
    """Run typed ticks (with the ``order`` column) through the high-water filter.

    All ticks of a key must come in one order, as from one topic partition.
    """
    return (
        rows.writeStream.queryName("high_water")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{sink.root}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
