"""Token ids as Parquet files that allow selective reads of ids and of metadata.

Below a folder lie ``tokens`` and ``parts``. ``tokens`` holds one row per document in
ascending id order, file after file: ``doc_id, part, before, n_tokens, ids``. The ids are a
dictionary-encoded list column; the other columns are delta-encoded, so that they cost next to
nothing and can be read without the ids. Row groups and pages have a set size and every column
has a page index: a filter on ``doc_id``, ``part`` or ``before`` opens few pages. ``parts``
holds one row per file with the number of ids before it, so that files are written in one pass
and nothing but a count per file is summed up over the whole corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import chunks
from tickloom.llm.tokens import WORD_ENDS, Rules, coder_of

GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000
TOKENS = "doc_id bigint, part int, before bigint, n_tokens bigint, ids array<int>"


def write_tokens(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    end: int,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: Rules = WORD_ENDS,
    group_bytes: int = GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every whole text (null: empty) with its end id and write the files below ``path``.

    Documents are range-partitioned and sorted by id; null ids come last. Rows with equal ids
    keep a row each, ordered by a hash of the text: they may fill several partitions, so no id
    can overload a task. Further columns are not read. An empty table gives empty files.
    """
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("_row").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary, rules)
        part = TaskContext.get().partitionId()
        before = 0
        for batch in chunks(source):
            ids = list(coder.ids(batch["text"].to_pylist(), end))
            lengths = np.array([len(one) for one in ids], np.int64)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            columns = [
                batch["doc_id"],
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(before + bounds[:-1]),
                pa.array(lengths),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
            ]
            before += int(bounds[-1])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "n_tokens", "ids"])

    (
        ranged.mapInArrow(encode, TOKENS)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("compression", "zstd")
        .parquet(f"{path}/tokens")
    )
    spark = documents.sparkSession
    counts = tokens(spark, path).groupBy("part").agg(
        F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_part"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    counts.withColumn("part_start", F.coalesce(F.sum("n_part").over(earlier), F.lit(0))).write.parquet(f"{path}/parts")


def tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; select or filter before an action, so that only these pages are read."""
    return spark.read.schema(TOKENS).parquet(f"{path}/tokens")


def parts(spark: SparkSession, path: str) -> DataFrame:
    kind = "part int, n_documents bigint, n_part bigint, first_id bigint, last_id bigint, part_start bigint"
    return spark.read.schema(kind).parquet(f"{path}/parts")


def index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` of every document, without reading any id."""
    starts = parts(spark, path).select("part", "part_start")
    light = tokens(spark, path).select("doc_id", "part", "before", "n_tokens")
    return light.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens")


def of_documents(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ids of the documents from ``first`` to ``last``; other row groups and pages stay closed."""
    return tokens(spark, path).filter(F.col("doc_id").between(first, last)).select("doc_id", "n_tokens", "ids")


def of_span(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """``start, ids`` of the stretch of the whole token stream, cut at its two ends.

    The files that hold it come from ``parts`` (their first and last number), the documents
    from the index of ``before``; order by ``start`` to read on.
    """
    stop = start + length
    files = parts(spark, path).filter((F.col("part_start") < stop) & (F.col("part_start") + F.col("n_part") > start))
    near = files.agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("part_start").alias("s"), F.max("part_start").alias("t")).first()
    if near["a"] is None:
        return spark.createDataFrame([], "start bigint, ids array<int>")
    rows = tokens(spark, path).filter(F.col("part").between(near["a"], near["b"]))
    # Bounds on a stored column alone: they reach the page index.
    rows = rows.filter(F.col("before") < stop - near["s"])
    if near["a"] == near["b"]:
        rows = rows.filter(F.col("before") + F.col("n_tokens") > start - near["s"])
    placed = rows.join(files.select("part", "part_start"), "part").withColumn("start", F.col("part_start") + F.col("before"))
    inside = placed.filter((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    keep = F.least(F.lit(stop), F.col("start") + F.col("n_tokens")) - F.col("start") - skip
    cut = F.slice("ids", (skip + 1).cast("int"), keep.cast("int"))
    return inside.select((F.col("start") + skip).alias("start"), cut.alias("ids"))


def with_checksums(rows: DataFrame, column: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """``doc_id, part, before, n_tokens`` and the crc32 of the ids as 32-bit little-endian numbers."""
    kept = ["doc_id", "part", "before", "n_tokens"]

    def digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            lists = batch[column]
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in kept), pa.array(sums, pa.int64())], [*kept, name])

    return rows.select(*kept, column).mapInArrow(digest, f"doc_id bigint, part int, before bigint, n_tokens bigint, {name} bigint")


def encoded(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, all read from the files."""
    starts = parts(spark, path).select("part", "part_start")
    checked = with_checksums(tokens(spark, path))
    return checked.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
