"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

The scatter is gathered by Spark in exact integers (blocks of centred products, added up), so it
is the same for every partitioning. What remains has the size of the vectors' dimension only: the
scatter is factored into a lower trapezoidal matrix with its rows permuted, and plane rotations
make the columns of that factor orthogonal. Their norms squared are the eigenvalues and, scaled
to length one, the columns are the components; the product of the factor with itself, which would
square its condition, is never formed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import stored

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
SWEEPS = 60
# Entries further from their mean are beyond exact 64-bit sums; entries, beyond exact doubles.
SPREAD = 1 << 26
LARGEST = 1 << 50


@dataclass
class Whitening:
    """Fitted on ``count`` vectors: integer sums per dimension, falling eigenvalues of the
    covariance (divisor ``count``), components as columns, and the covariance's trace."""

    count: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vector``: no null, empty or non-finite ones, all as long as most of them are
    (equally many: the longer)."""
    vector = F.transform(F.col(embedding), lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), vector.alias("vector"))
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = rows.filter((F.size("vector") > 0) & F.forall("vector", sound))
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    return rows.filter(F.size("vector") == (most["width"] if most else 0))


def integers(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch["vector"].flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat.reshape(-1, width) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"entries beyond {LARGEST} / {SCALE}")
    return scaled.astype(np.int64) + SHIFT


def offcentre(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    y = x - middle
    if len(y) and np.abs(y).max() >= SPREAD:
        raise ValueError(f"entries further than {SPREAD} / {SCALE} from their mean")
    return y


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of integers, exact: blocks small enough that doubles hold every sum."""
    total = np.zeros((y.shape[1],) * 2, np.int64)
    if len(y):
        most = max(1, int(np.abs(y).max()))
        rows = max(1, (1 << 53) // (most * most))
        for start in range(0, len(y), rows):
            part = y[start : start + rows].astype(float)
            total += (part.T @ part).astype(np.int64)
    return total


def added(rows: DataFrame, column: str, by: str | None = None) -> dict:
    """Exact sum of an array column, by its places (and by ``by``)."""
    keys = [by] if by else []
    places = rows.select(*keys, F.posexplode(column).alias("i", "v"))
    total = places.groupBy(*keys, "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    return {tuple(row)[:-1]: int(row["v"]) for row in total.collect()}


def scatter(rows: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and ``count`` times the centred scatter, in whole numbers.

    Entries are centred at the rounded mean before they are multiplied; the rest of the mean
    (less than one half) is taken out of the sums afterwards, without rounding. The driver
    gets ``width * width`` numbers.
    """

    def first(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for batch in source:
            x = integers(batch, width)
            total += np.append(x.sum(axis=0), len(x))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["v"])

    found = added(rows.mapInArrow(first, "v array<bigint>"), "v")
    count = found.get((width,), 0)
    sums = [found.get((i,), 0) for i in range(width)]
    if not count:
        return 0, sums, np.zeros((width, width), object)
    middle = np.array([(2 * s + count) // (2 * count) for s in sums], np.int64)
    rest = [s - count * int(m) for s, m in zip(sums, middle)]

    def second(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), np.int64)
        for batch in source:
            total += products(offcentre(integers(batch, width), middle))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.int64()))], ["k", "v"])

    cells = added(rows.mapInArrow(second, "k int, v array<bigint>"), "v", "k")
    whole = np.array([[count * cells.get((i, j), 0) - rest[i] * rest[j] for j in range(width)] for i in range(width)], object)
    return count, sums, whole


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``f`` with ``f @ f.T = a``: lower trapezoidal in the order of the pivots, rows in the order
    of ``a``; one column for every pivot above the rounding of the largest."""
    size = len(a)
    left = a.diagonal().copy()
    factor = np.zeros((size, size))
    floor = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    todo = np.ones(size, bool)
    for step in range(size):
        pivot = int(np.where(todo, left, -np.inf).argmax())
        if left[pivot] <= floor:
            return factor[:, :step]
        todo[pivot] = False
        root = left[pivot] ** 0.5
        column = np.where(todo, (a[:, pivot] - factor[:, :step] @ factor[pivot, :step]) / root, 0.0)
        column[pivot] = root
        factor[:, step] = column
        left = np.where(todo, left - column**2, left)
    return factor


def pairings(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each of ``count`` columns meets each other one once."""
    ring = list(range(count + count % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:half], ring[half:][::-1]) if max(a, b) < count]
        if pairs:
            yield tuple(np.array(side) for side in zip(*pairs))
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and components (columns) of ``factor @ factor.T``.

    Rotations in the planes of two columns until every pair is orthogonal to working precision.
    """
    g = factor.astype(float).copy()
    tolerance = max(1, len(g)) ** 0.5 * np.finfo(float).eps
    for _ in range(sweeps):
        worst = 0.0
        for p, q in pairings(g.shape[1]):
            one, two = g[:, p], g[:, q]
            alpha, beta, gamma = (one * one).sum(0), (two * two).sum(0), (one * two).sum(0)
            scale = np.sqrt(alpha * beta)
            cosine = np.abs(np.divide(gamma, scale, out=np.zeros_like(gamma), where=scale > 0))
            worst = max(worst, cosine.max())
            turn = cosine > tolerance
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = c * (one - t * two), c * (two + t * one)
        if worst <= tolerance:
            break
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    vectors = g[:, order] / norms[order]
    if vectors.size:  # of the two signs, the one whose largest entry is positive
        largest = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return norms[order] ** 2, vectors


def fit(rows: DataFrame, width: int) -> Whitening:
    count, sums, whole = scatter(rows, width)
    if not count:
        return Whitening(0, sums, np.empty(0), np.empty((width, 0)), 0.0)
    covariance = np.array([[cell / count**2 for cell in row] for row in whole], float)
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    return Whitening(count, sums, values, vectors, sum(whole[i, i] for i in range(width)) / count**2)


def project(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array of up to ``components`` numbers) of every row.

    ``deviation`` is the exact sum of (n * x - S)**2, null where that has more than 64 bits.
    """
    width, count = len(model.sums), model.count
    middle = np.array([(2 * s + count) // (2 * count) for s in model.sums], np.int64)
    rest = [s - count * int(m) for s, m in zip(model.sums, middle)]
    kept = min(components, len(model.values))
    turn = model.vectors[:, :kept] / np.sqrt(model.values[:kept])
    square, most = sum(r * r for r in rest), max(map(abs, rest), default=0)

    def out(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            y = offcentre(integers(batch, width), middle)
            far = int(np.abs(y).max(initial=0))
            if (far * count + most) ** 2 * width < 1 << 62:
                off = y * count - np.array(rest, np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:  # n**2 * sum(y*y) - 2 * n * sum(y * rest) + sum(rest * rest), without limits
                cross = y.astype(object) @ np.array(rest, object)
                whole = [count * count * int(a) - 2 * count * int(b) + square for a, b in zip((y * y).sum(axis=1), cross)]
                deviation = [d if d < 1 << 63 else None for d in whole]
            centred = y - np.array([r / count for r in rest])
            white = pa.array(list(centred @ turn), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(deviation, pa.int64()), white], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(out, "vec_id bigint, deviation bigint, whitened array<double>")


def identity_error(projected: DataFrame, count: int, components: int) -> float:
    """Largest absolute entry of the whitened columns' covariance less the identity."""
    if not components:
        return 0.0
    entry = [F.get("whitened", F.lit(i)) for i in range(components)]
    means = list(projected.agg(*[F.avg(e) for e in entry]).first())
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    sums = projected.agg(*[F.sum((entry[i] - means[i]) * (entry[j] - means[j])) for i, j in pairs]).first()
    return max(abs(total / count - (i == j)) for total, (i, j) in zip(sums, pairs))


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per kept row and component ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Entries c count as x = floor(1024 * c) + 100000. Rows whose vector is null, empty or of a
    length other than most, or holds null or non-finite entries, take no part; every other row
    does, whether its id is null or repeated. Components without variance do not exist: fewer
    than ``components`` come out where the vectors span fewer dimensions, and no row for equal
    vectors or an empty table. Further columns are not read.
    """
    kept = usable(vectors, vec_id, embedding)
    one = kept.select(F.size("vector").alias("width")).first()
    layout = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if one is None:
        return vectors.sparkSession.createDataFrame([], layout)
    model = fit(kept, one["width"])
    projected = stored(project(kept, model, components))
    count = min(components, len(model.values))
    error = identity_error(projected, model.count, count)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:count]] or [F.lit(0.0)])
    unfolded = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return unfolded.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.count).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
