"""Checks of each micro-batch, counted while it is written, as rows of the quality log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from tickloom.asof import AsOf
from tickloom.plans import quality
from tickloom.schemas import DQ_RESULT
from tickloom.streaming.batches import BatchTable

STAGE = "spark_inflight"


@dataclass(frozen=True)
class InflightQuality:
    """``foreachBatch`` target that hands each batch on to ``write`` and logs its checks.

    The counts are observed on the rows that ``write`` runs, so the batch is computed once;
    ``write`` must run it as a whole, once, and overwrite what an earlier run of the same batch
    left. The log rows of a batch replace those of an earlier run of it. They say which batch
    they belong to and, as their time, when it was checked (``as_of``: a fixed instant).
    """

    write: Callable[[DataFrame, int], object]
    root: str
    checks: Sequence[quality.Check] | None = None
    as_of: AsOf = AsOf()

    @property
    def log(self) -> BatchTable:
        return BatchTable(self.root, "execution_ts", ("check_name",))

    def declared(self) -> list[quality.Check]:
        if self.checks is not None:
            return list(self.checks)
        return [*quality.tick_checks(self.as_of), quality.missing_keys(), *quality.expression_checks(), quality.accepted_sector_check()]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        checks, seen = self.declared(), Observation()
        self.write(batch.observe(seen, *quality.check_counts(checks)), batch_id)
        counts = batch.sparkSession.createDataFrame([seen.get])
        results = quality.check_results(counts, checks)
        self.log.write(quality.result_log(results, self.as_of, f"batch-{batch_id}", STAGE), batch_id)

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.log.read(spark, DQ_RESULT)
