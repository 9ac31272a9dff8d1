"""Centroid clustering (Lloyd's algorithm) with heap-ordered bounds.

The gap of a vector is its distance to the second nearest centroid (a lower bound from then on)
less that to its own (an upper bound). Whenever centroids move, the gap can shrink by the drift
of the own centroid plus the largest drift of another one. Each cluster adds these up in one
number, and a vector enters the cluster's heap under its gap plus that number at the time: while
its key is above the number, its cluster is certain. A round pops what is not, and only these
vectors are compared with all centroids again.

Vectors lie in blocks of a few thousand, one row each, which hold the heaps of their vectors: an
array in ascending order is a heap, and all that expires in a round is a prefix of it. Blocks
depend on nothing but the centroids, so neither large clusters nor copies can overload a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import batches, discard, stored

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
BLOCK = 4096
# Larger components have squared distances beyond 64 bits.
LIMIT = 1 << 28
# Covers the rounding of distances and drifts, which are kept in double precision.
SLACK = 1e-3
STATE = (
    "vec_id array<bigint>, x binary, keys array<double>, places array<int>, heads array<int>, "
    "rescanned bigint, counts array<bigint>, sums array<bigint>"
)
NAMES = [part.split()[0] for part in STATE.split(", ")]


@dataclass
class Clustering:
    """``members``: ``vec_id, cluster, distance`` (squared) of every vector; the final centroids;
    how many vectors each assignment compared with all centroids."""

    members: DataFrame
    centroids: list[list[int]]
    rescanned: list[int] = field(default_factory=list)


def usable(vectors: DataFrame, vec_id: str, embedding: str, width: int) -> DataFrame:
    vector = F.transform(F.col(embedding), lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), vector.alias("vector"))
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return rows.filter((F.size("vector") == width) & F.forall("vector", sound))


def integers(flat: np.ndarray, width: int, scale: int) -> np.ndarray:
    scaled = np.floor(flat.reshape(-1, width) * scale)
    if len(scaled) and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"components beyond {LIMIT} / {scale} have no exact 64-bit distance")
    return scaled.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: smaller number), and the gap to the second."""
    squares = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    own = squares.argmin(axis=1)
    if len(centroids) == 1:
        return own, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(squares, 1, axis=1)[:, :2].astype(float))
    return own, two[:, 1] - two[:, 0]


def sums_of(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    total = np.zeros((k, x.shape[1]), np.int64)
    np.add.at(total, cluster, x)
    return total


def push(rest: tuple[np.ndarray, np.ndarray], keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add (key, place) entries to a heap."""
    order = np.argsort(keys, kind="stable")
    at = np.searchsorted(rest[0], keys[order])
    return np.insert(rest[0], at, keys[order]), np.insert(rest[1], at, places[order])


def rows_of(states: list[tuple]) -> pa.RecordBatch:
    kinds = [
        pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
        pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*states), kinds)], NAMES)


def packed(ids: list, x: np.ndarray, heaps: list[tuple[np.ndarray, np.ndarray]], seen: int, counts: np.ndarray, sums: np.ndarray) -> tuple:
    heads = np.cumsum([0, *(len(keys) for keys, _ in heaps)])
    keys, places = (np.concatenate([heap[i] for heap in heaps]) for i in (0, 1))
    return ids, x.astype(np.int32).tobytes(), keys, places, heads, seen, counts, sums.ravel()


def heaps_in(row: dict, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, places, heads = (np.asarray(row[name]) for name in ("keys", "places", "heads"))
    return [(keys[heads[c] : heads[c + 1]].astype(float), places[heads[c] : heads[c + 1]].astype(np.int64)) for c in range(k)]


def build(kept: DataFrame, centroids: list[list[int]], width: int, scale: int, block: int) -> DataFrame:
    """First assignment: every vector is compared with every centroid."""
    points = np.array(centroids, np.int64)
    k = len(points)

    def fill(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, block):
            x = integers(batch["vector"].flatten().to_numpy(zero_copy_only=False), width, scale)
            own, gaps = nearest(x, points)
            none = (np.empty(0), np.empty(0, np.int64))
            heaps = [push(none, gaps[own == c], np.flatnonzero(own == c)) for c in range(k)]
            state = packed(batch["vec_id"].to_pylist(), x, heaps, len(x), np.bincount(own, minlength=k), sums_of(x, own, k))
            yield rows_of([state])

    return kept.mapInArrow(fill, STATE)


def advance(state: DataFrame, centroids: list[list[int]], spent: list[float], width: int) -> DataFrame:
    """Next assignment: pop what expired, compare it with all centroids, push it again.

    ``counts`` and ``sums`` of the result are the changes only.
    """
    points = np.array(centroids, np.int64)
    k = len(points)
    offset = np.array(spent)

    def step(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 1):
            row = {name: batch[name].to_pylist()[0] for name in NAMES}
            x = np.frombuffer(row["x"], np.int32).reshape(-1, width).astype(np.int64)
            heaps = heaps_in(row, k)
            ends = [int(np.searchsorted(keys, offset[c] + SLACK, "right")) for c, (keys, _) in enumerate(heaps)]
            popped = np.concatenate([places[:end] for (_, places), end in zip(heaps, ends)])
            was = np.repeat(np.arange(k), ends)
            heaps = [(keys[end:], places[end:]) for (keys, places), end in zip(heaps, ends)]
            counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
            if len(popped):
                own, gaps = nearest(x[popped], points)
                heaps = [push(heap, gaps[own == c] + offset[c], popped[own == c]) for c, heap in enumerate(heaps)]
                moved = own != was
                counts = np.bincount(own[moved], minlength=k) - np.bincount(was[moved], minlength=k)
                sums = sums_of(x[popped[moved]], own[moved], k) - sums_of(x[popped[moved]], was[moved], k)
            yield rows_of([packed(row["vec_id"], x, heaps, len(popped), counts, sums)])

    return state.mapInArrow(step, STATE)


def totals(state: DataFrame, column: str, size: int) -> list[int]:
    """Componentwise sum over the blocks, exact at any number of vectors."""
    added = state.select(F.posexplode(column).alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {row["i"]: int(row["v"]) for row in added.collect()}  # one row per centroid component
    return [found.get(i, 0) for i in range(size)]


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    width: int = WIDTH,
    scale: int = SCALE,
    block: int = BLOCK,
) -> Clustering:
    """Cluster the vectors, in integers: floor(scale * component), exact means rounded down.

    Kept are vectors of ``width`` components, none of them null or non-finite; every row with one
    counts, whether its id is null or repeated. Centroids start as the ``k`` kept vectors (all,
    if fewer) with the smallest sha256 of ``seed:vec_id`` (a null id: nothing behind the colon),
    equal hashes by vector. Equal distances go to the smaller centroid; one without vectors stays.
    Further columns are not read. No kept vector: no rows, no centroids.

    Tables grow with the vectors and stay in storage between rounds (the one before is deleted);
    the driver holds ``k * width`` numbers.
    """
    kept = usable(vectors, vec_id, embedding, width)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select("vector", F.sha2(name, 256).alias("h")).orderBy("h", "vector").limit(k).collect()
    if not first:
        return Clustering(vectors.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), [])
    centroids = [integers(np.array(row["vector"]), width, scale)[0].tolist() for row in first]
    k = len(centroids)
    state = stored(build(kept, centroids, width, scale, block))
    counts, sums, spent = [0] * k, [0] * (k * width), [0.0] * k
    rescanned = []
    for _ in range(rounds):
        rescanned.append(state.agg(F.sum("rescanned")).first()[0])
        counts = [a + b for a, b in zip(counts, totals(state, "counts", k))]
        sums = [a + b for a, b in zip(sums, totals(state, "sums", k * width))]
        moved = [[s // n for s in sums[c * width : (c + 1) * width]] if n else centroids[c] for c, n in enumerate(counts)]
        drift = [sum((a - b) ** 2 for a, b in zip(new, old)) ** 0.5 for new, old in zip(moved, centroids)]
        if not any(drift):  # every later round would repeat this one
            break
        centroids = moved
        spent = [spent[c] + drift[c] + max([0.0, *drift[:c], *drift[c + 1 :]]) for c in range(k)]
        after = stored(advance(state, centroids, spent, width))
        discard(state)
        state = after
    else:
        rescanned.append(state.agg(F.sum("rescanned")).first()[0])
    points = np.array(centroids, np.int64)

    def final(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 1):
            row = {name: batch[name].to_pylist()[0] for name in NAMES[:5]}
            x = np.frombuffer(row["x"], np.int32).reshape(-1, width).astype(np.int64)
            own = np.zeros(len(x), np.int32)
            for c, (_, places) in enumerate(heaps_in(row, k)):
                own[places] = c
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["vec_id"], pa.int64()), pa.array(own), pa.array(((x - points[own]) ** 2).sum(axis=1))], ["vec_id", "cluster", "distance"]
            )

    members = stored(state.select(*NAMES[:5]).mapInArrow(final, "vec_id bigint, cluster int, distance bigint"))
    discard(state)
    return Clustering(members, centroids, rescanned)


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(found: Clustering) -> DataFrame:
    """Append ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to the members."""
    whole = F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint")
    rows = found.members.groupBy("cluster").agg(whole.alias("v")).collect()  # one row per centroid
    each = {row["cluster"]: row["v"] for row in rows}
    per = F.array(*[F.lit(each.get(c, 0)).cast("bigint") for c in range(len(found.centroids))] or [F.lit(0).cast("bigint")])
    names = F.array(*[F.lit(digest(c)) for c in found.centroids] or [F.lit("")])
    return found.members.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(per, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(each.values())).cast("bigint").alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid_sha256"),
    )
