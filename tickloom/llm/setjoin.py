"""Set-similarity helpers of the shingle join and the line join."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import discard, mixed, stored

CELLS = 1 << 22
CHUNK = 1 << 16
# Bytes of the bitmap of repeated signatures: 16 bits a signature, within these bounds.
BITMAP = (1 << 16, 1 << 25)
FREQUENT = 1 << 17


@dataclass
class TokenCounts:
    """How often tokens occur, in a fixed number of cells that tokens are hashed to.

    A cell counts all tokens that fall into it, so the counts are upper bounds. They serve as
    a global order and to tell frequent tokens apart; a link never depends on their precision.
    """

    cells: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return self.cells[(tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)]

    @property
    def frequent(self) -> int:
        """Tokens that occur at least so often are of the frequent class."""
        return max(8, int(self.cells.sum(dtype=np.int64)) // FREQUENT)

    def ordered(self, tokens: np.ndarray) -> np.ndarray:
        """The tokens, rarest first; equally rare ones by their hash."""
        return tokens[np.lexsort((mixed(tokens), self.of(tokens)))]


def token_counts(rows: DataFrame, blocks: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> TokenCounts:
    """Counts of all tokens of ``rows``, 16 MB at every size of the input.

    Every task adds its tokens up in one array, sent on in compressed chunks; chunks with
    the same number are added up in groups, so that no task holds more than a few.
    """
    kind = "chunk int, part int, body binary"
    shift = np.uint64(64 - CELLS.bit_length() + 1)

    def packed(chunk: int, part: int, counts: np.ndarray) -> dict:
        return {"chunk": chunk, "part": part, "body": zlib.compress(counts.tobytes(), 1)}

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for block in blocks(source):
            np.add.at(cells, (block >> shift).astype(np.int64), np.uint32(1))
        task = TaskContext.get().partitionId()
        for chunk in range(CELLS // CHUNK):
            part = cells[chunk * CHUNK : (chunk + 1) * CHUNK]
            if part.any():
                yield pa.RecordBatch.from_pylist([packed(chunk, task % 64, part)], _CHUNKS)

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CHUNK, np.uint64)
        number = 0
        for batch in frames:
            for chunk, body in zip(batch["chunk"].to_pylist(), batch["body"].to_pylist()):
                number = chunk
                total += np.frombuffer(zlib.decompress(body), np.uint32)
        yield pa.RecordBatch.from_pylist([packed(number, 0, np.minimum(total, (1 << 32) - 1).astype(np.uint32))], _CHUNKS)

    sums = rows.mapInArrow(count, kind).groupBy("chunk", "part").applyInArrow(add, kind)
    sums = sums.groupBy("chunk").applyInArrow(add, kind)
    cells = np.zeros(CELLS, np.uint32)
    for row in stored(sums).toLocalIterator():  # at most CELLS / CHUNK rows
        cells[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["body"]), np.uint32)
    return TokenCounts(cells)


_CHUNKS = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("body", pa.binary())])


@dataclass
class Repeated:
    """Signatures that occur at least twice, as a bitmap: others pass too, none is missed."""

    bits: np.ndarray

    def among(self, signatures: np.ndarray) -> np.ndarray:
        """True where a signature may occur twice."""
        byte, bit = _cells(signatures, len(self.bits))
        return (self.bits[byte] >> bit) & 1 != 0


def _cells(signatures: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    cell = mixed(signatures.view(np.uint64)) & np.uint64(8 * size - 1)
    return (cell >> np.uint64(3)).astype(np.int64), (cell & np.uint64(7)).astype(np.uint8)


def repeated(signatures: DataFrame) -> Repeated:
    """Filter of the values of column ``sig`` that stand in several rows.

    Most signatures stand in one row and meet nobody: the filter keeps them out of the
    joins. Its size follows the number of repeated ones up to 32 MB; in a table too large
    for that it lets more pass, and the joins that follow drop them.
    """
    return marked(signatures.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1").select("sig"))


def marked(twice: DataFrame) -> Repeated:
    """The filter of the values in column ``sig``."""
    twice = stored(twice)
    wanted = 2 * twice.count()
    size = min(max(BITMAP[0], 1 << wanted.bit_length()), BITMAP[1])
    kind = "chunk int, part int, body binary"

    def mark(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, np.uint8)
        for batch in source:
            byte, bit = _cells(batch["sig"].to_numpy(), size)
            np.bitwise_or.at(bits, byte, np.uint8(1) << bit)
        task = TaskContext.get().partitionId()
        for chunk in range(size // CHUNK):
            part = bits[chunk * CHUNK : (chunk + 1) * CHUNK]
            if part.any():
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "part": task % 64, "body": zlib.compress(part.tobytes(), 1)}], _CHUNKS)

    def merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(CHUNK, np.uint8), 0
        for batch in frames:
            for number, body in zip(batch["chunk"].to_pylist(), batch["body"].to_pylist()):
                total |= np.frombuffer(zlib.decompress(body), np.uint8)
        yield pa.RecordBatch.from_pylist([{"chunk": number, "part": 0, "body": zlib.compress(total.tobytes(), 1)}], _CHUNKS)

    merged = stored(twice.mapInArrow(mark, kind).groupBy("chunk", "part").applyInArrow(merge, kind).groupBy("chunk").applyInArrow(merge, kind))
    bits = np.zeros(size, np.uint8)
    for row in merged.toLocalIterator():  # at most 512 rows
        bits[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["body"]), np.uint8)
    discard(twice)
    discard(merged)
    return Repeated(bits)


def overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("rid").alias("a"), F.col("tokens").alias("of_a"))
    two = sets.select(F.col("rid").alias("b"), F.col("tokens").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    return pairs.join(one, "a").join(two, "b").filter(100 * both >= percent * either).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of all nodes of the links (a, b).

    Every round each node takes the smallest label around it, then the label of its label,
    until nothing changes.
    """
    around = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = around.groupBy("a").agg(F.min("b").alias("m"))
    labels = labels_of = stored(labels.select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = around.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "component", F.least("component", "m").alias("next"))
        met = stored(met)
        jump = met.select(F.col("node").alias("next"), F.col("next").alias("further"))
        after = stored(met.join(jump, "next").select("node", "component", F.least("next", "further").alias("next")))
        changed = after.filter("next < component").limit(1).count()
        discard(met)
        discard(labels_of)
        labels_of = after
        labels = after.select("node", F.col("next").alias("component"))
        if not changed:
            discard(around)
            return labels
