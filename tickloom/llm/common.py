"""Helpers shared by the operators: stored intermediate tables, words and hashes."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import ensure_checkpoint_dir

# Separators of words in every contract: space and U+0009..U+000D. bytes.split() without
# an argument separates at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table_path(spark: SparkSession, kind: str = "table") -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: a lost executor
    costs no recomputation beyond this point, and columns can be pruned."""
    path = table_path(df.sparkSession)
    df.write.parquet(path)
    # Shuffle files of finished jobs go when the JVM collects what refers to them.
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote and that nothing reads any more."""
    folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    for folder in folders:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` start, and a 64-bit hash of each (A-Z count as a-z)."""
    content = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(content) + 2, bool)
    inside[1:-1] = ~SEPARATOR[content]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    forward, back = _powers(len(content) + 1)
    sums = np.zeros(len(content) + 1, np.uint64)
    np.cumsum(BYTES[content] * forward[: len(content)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * back[starts])


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0, 1, ... of an odd base modulo 2**64, and their inverses."""
    if len(_POWERS[0]) < count:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            values = np.full(2 * count, base, np.uint64)
            values[0] = 1
            _POWERS[k] = np.multiply.accumulate(values)
    return _POWERS[0], _POWERS[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def windows_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for every run of ``size`` consecutive values."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        if size <= 8:
            for k in range(size):
                total = total * base + hashes[k : k + count]
        else:
            powers = np.ones(len(hashes) + 1, np.uint64)
            powers[1:] = base
            powers = np.multiply.accumulate(powers)
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            back = np.full(count, inverse, np.uint64)
            back[0] = power
            back = np.multiply.accumulate(back)
            sums = np.concatenate([[np.uint64(0)], np.add.accumulate(hashes * powers[:-1])])
            total = (sums[size:] - sums[:-size]) * back
    return mixed(total)


BASE = 0x9E3779B97F4A7C15
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
BYTES = mixed(np.arange(1, 257))
BYTES[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]
SEPARATOR = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def chunks(source: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text stands alone."""
    for batch in source:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def batches(source: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in source:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def frequent(counted: Iterator[np.ndarray], counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Mergeable frequency summary (Misra-Gries) of a stream of value arrays: every value
    holding more than 1/counters of the stream is among the returned values."""
    values, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for block in counted:
        fresh, times = np.unique(block, return_counts=True)
        merged, where = np.unique(np.concatenate([values, fresh]), return_inverse=True)
        total = np.bincount(where, np.concatenate([counts, times]), len(merged)).astype(np.int64)
        if len(merged) > counters:
            total -= np.partition(total, len(total) - counters - 1)[len(total) - counters - 1]
        values, counts = merged[total > 0], total[total > 0]
    return values, counts
