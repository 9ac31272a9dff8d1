"""Rows of micro-batches as a table whose number of files does not grow with the batches.

A batch owns the folder of its id and overwrites it, so running it again changes nothing. Every
so many batches the folders of finished ones are packed into day partitions, which are published
by version: readers see each row once, before, during and after.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.operators import folders, versions

PACK_EVERY = 100
DAY = "_day"
BATCH = "_batch"
# Day of rows without a time.
NO_DAY = "DATE '1970-01-01'"


@dataclass(frozen=True)
class BatchTable:
    """Rows below ``root``; ``time`` is the column whose day the packed rows are stored by.

    ``root`` belongs to one stream checkpoint, and one batch runs at a time.
    """

    root: str
    time: str
    cluster_by: tuple[str, ...] = ()
    pack_every: int = PACK_EVERY

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of a batch; the first batch after ``pack_every`` others packs those."""
        rows.write.mode("overwrite").parquet(self.folder(batch_id))
        if len(self._waiting(rows.sparkSession, batch_id)) >= self.pack_every:
            self.pack(rows.sparkSession, rows.schema, batch_id)

    def pack(self, spark: SparkSession, schema: T.StructType, before: int) -> None:
        """Move the rows of batches below ``before``, which are finished, into their days.

        Days that get rows are written anew, in ranges of (day, ``cluster_by``, time), then
        published. If the run ends before the folders are gone, the next one starts from the
        same folders: packed rows of these batches are left out of what it carries over.
        """
        numbers = self._waiting(spark, before)
        if not numbers:
            return
        fresh = self._batches(spark, schema, numbers)
        day = F.coalesce(F.to_date(self.time), F.expr(NO_DAY))
        fresh = fresh.withColumn(DAY, day)
        days = [row[0] for row in fresh.select(DAY).distinct().collect()]
        if days:
            kept = self._packed(spark)
            if kept is not None:
                kept = kept.filter(F.col(DAY).isin(days) & (F.col(BATCH) < numbers[0]))
                fresh = kept.unionByName(fresh)
            versions.publish(fresh, self._home, DAY, self.cluster_by, (self.time,), days=days)
            versions.drop_superseded(spark, self._home)
        for number in numbers:
            folders.delete(spark, self.folder(number))

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Every row stored so far, once."""
        packed = self._packed(spark)
        last = -1 if packed is None else packed.agg(F.max(BATCH)).first()[0]
        numbers = [n for n in self._waiting(spark) if n > (-1 if last is None else last)]
        loose = self._batches(spark, schema, numbers) if numbers else spark.createDataFrame([], schema)
        loose = loose.select(*schema.names)
        return loose if packed is None else packed.select(*schema.names).unionByName(loose)

    @property
    def _home(self) -> str:
        return f"{self.root}/packed"

    def folder(self, batch_id: int) -> str:
        return f"{self.root}/batches/{BATCH}={batch_id}"

    def _waiting(self, spark: SparkSession, before: int | None = None) -> list[int]:
        named = folders.names(spark, f"{self.root}/batches")
        numbers = sorted(int(name.partition("=")[2]) for name in named if name.startswith(f"{BATCH}="))
        return [n for n in numbers if before is None or n < before]

    def _batches(self, spark: SparkSession, schema: T.StructType, numbers: list[int]) -> DataFrame:
        wide = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        reader = spark.read.schema(wide).option("basePath", f"{self.root}/batches")
        return reader.parquet(*[self.folder(n) for n in numbers])

    def _packed(self, spark: SparkSession) -> DataFrame | None:
        try:
            return versions.current(spark, self._home, DAY)
        except FileNotFoundError:
            return None
