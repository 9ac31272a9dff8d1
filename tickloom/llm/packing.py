"""Best-fit packing by a configuration linear program over the length histogram."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import chunks, stored
from tickloom.llm.tokens import BYTE_LEVEL, Rules, coder_of
from tickloom.operators.keys import number_rows

CAPACITY = 1024
END = 2
# First price of a length l: (l / capacity) ** POWER. Above 1, so that of two full sequences the
# one with the longer pieces, which fit fewer others, is priced higher.
POWER = 1.2
# How much the weights of lengths that are covered ahead of the others fall.
RATE = 0.1
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(documents: DataFrame, vocabulary: str, rules: Rules = BYTE_LEVEL, capacity: int = CAPACITY) -> DataFrame:
    """Token ids of each whole text (null: empty) and the end id, cut if longer than
    ``capacity``; the first piece takes the remainder. One row per piece.

    The ids are those of the tokenizers library for the file, special tokens included. A row
    with a null or repeated id gives its own pieces. Further columns are not read.
    """

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary, rules)
        for batch in chunks(source):
            rows = []
            for name, ids in zip(batch["doc_id"].to_pylist(), coder.ids(batch["text"].to_pylist(), END)):
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((name, number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECE)


def price(values: np.ndarray, left: np.ndarray, capacity: int) -> Counter:
    """Best-valued configuration: lengths that fit the capacity together, no length more often
    than ``left`` has it. Knapsack by dynamic programming; copies of a length count as one,
    two, four ... at a time."""
    items = []
    for length in np.flatnonzero(left > 0).tolist():
        copies, times = int(min(left[length], capacity // length)), 1
        while copies > 0:
            items.append((length, min(times, copies)))
            copies -= times
            times *= 2
    best = np.zeros(capacity + 1)
    chosen = np.zeros((len(items), capacity + 1), bool)
    for row, (length, times) in zip(chosen, items):
        weight = length * times
        with_it = best[: capacity + 1 - weight] + values[length] * times
        np.greater(with_it, best[weight:] + 1e-12, out=row[weight:])
        np.maximum(best[weight:], with_it, out=best[weight:], where=row[weight:])
    found: Counter = Counter()
    room = capacity
    for place in range(len(items) - 1, -1, -1):
        if chosen[place, room]:
            length, times = items[place]
            found[length] += times
            room -= length * times
    return found


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing over counts of lengths, equal bins handled together."""
    left = counts.astype(np.int64).copy()
    plan = []
    for largest in range(capacity, 0, -1):
        while left[largest] > 0:
            content: Counter = Counter()
            room, length = capacity, largest
            while length > 0:
                while length > 0 and (left[length] - content[length] <= 0 or length > room):
                    length = min(length - 1, room)
                if length > 0:
                    content[length] += 1
                    room -= length
            times = min(int(left[l] // n) for l, n in content.items())
            for l, n in content.items():
                left[l] -= n * times
            plan.append((times, dict(content)))
    return plan


def plan_sequences(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how often, {length: pieces}) of the sequences that hold every piece of the histogram.

    The covering program has a variable per configuration (a multiset of lengths that fits) and
    a row per length. Multiplicative weights solve it: every round prices the best configuration
    under the lengths' weights, raises its variable until the scarcest of its lengths is used up,
    and the weights of lengths covered ahead of the others fall. The amount of a round is rounded
    down to whole sequences at once (one at least) and what is left is priced on, so nothing is
    covered twice and no rest remains for another method. Works on one number per length,
    whatever the number of documents.
    """
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[int, dict[int, int]]] = []
    if left[capacity]:
        plan.append((int(left[capacity]), {capacity: 1}))
        left[capacity] = 0
    wanted = left.astype(float)
    lengths = np.arange(capacity + 1)
    start = (lengths / capacity) ** POWER
    while left.any():
        open_ = np.divide(left, wanted, out=np.zeros(capacity + 1), where=wanted > 0)
        mean = (left * lengths).sum() / (wanted * lengths).sum()
        weights = start * np.exp(RATE * np.clip(open_ / mean - 1, -5, 5))
        found = price(weights, left, capacity)
        times = max(1, min(int(left[l] // n) for l, n in found.items()))
        for l, n in found.items():
            left[l] -= n * times
        plan.append((times, dict(found)))
    return plan


def placements(plan: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length: (first piece number, first sequence, pieces a sequence, offset)."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    given: Counter = Counter()
    sequence = 0
    for times, content in plan:
        offset = 0
        for length in sorted(content, reverse=True):
            found.setdefault(length, []).append((given[length], sequence, content[length], offset))
            given[length] += times * content[length]
            offset += length * content[length]
        sequence += times
    return found


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to pieces with a ``length``.

    Pieces are numbered within their length over range partitions, so any number of pieces
    may share a length; ids may be null or repeated. The driver sees the histogram, at most
    ``capacity`` rows.
    """
    order = [F.col("length").asc(), F.col("doc_id").asc_nulls_last(), F.col("piece").asc()]
    numbered, _ = number_rows(cut, "_row", order)
    numbered = stored(numbered)
    rows = numbered.groupBy("length").agg(F.count("*").alias("n"), F.min("_row").alias("first")).collect()
    histogram = np.zeros(capacity + 1, np.int64)
    first = {row["length"]: row["first"] for row in rows}
    for row in rows:
        histogram[row["length"]] = row["n"]
    slots = {length: tuple(map(np.array, zip(*found))) for length, found in placements(plan_sequences(histogram, capacity)).items()}
    shared = cut.sparkSession.sparkContext.broadcast((first, slots))
    names = cut.columns

    def place(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, known = shared.value
        for frame in source:
            sequences, offsets = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            lengths = frame["length"].to_numpy()
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                number = frame["_row"].to_numpy()[at] - starts[length]
                begins, firsts, each, offset = known[length]
                slot = np.searchsorted(begins, number, "right") - 1
                within = number - begins[slot]
                sequences[at] = firsts[slot] + within // each[slot]
                offsets[at] = offset[slot] + length * (within % each[slot])
            yield frame[names].assign(sequence_id=sequences, offset=offsets)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return numbered.mapInPandas(place, f"{fields}, sequence_id bigint, offset bigint")
