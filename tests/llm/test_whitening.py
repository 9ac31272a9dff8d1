"""Whitening against exact fractions and numpy's eigenvalues."""

from fractions import Fraction

import numpy as np
import pytest

from tickloom.llm import queries, whitening


def brute(rows):
    kept = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in rows if v is not None]
    n = len(kept)
    sums = [sum(column) for column in zip(*(x for _, x in kept))]
    width = len(sums)
    centred = [[Fraction(n * a - s, n) for a, s in zip(x, sums)] for _, x in kept]
    covariance = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in kept]
    white = np.array([[float(c) for c in row] for row in centred]) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return kept, n, deviation, white, values / np.trace(covariance)


def check(got, rows, components):
    kept, n, deviation, white, shares = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by) == list(range(1, components + 1))
    for c, found in by.items():
        assert len(found) == n
        mine = np.array([found[i]["whitened"] for i, _ in kept])
        theirs = white[:, c - 1]
        sign = np.sign(mine @ theirs)
        assert np.abs(mine - sign * theirs).max() < 1e-7
        for (i, _), d in zip(kept, deviation):
            assert found[i]["deviation"] == d and found[i]["n"] == n
            assert abs(found[i]["explained"] - shares[c - 1]) <= 1e-10
            assert found[i]["identity_error"] < 1e-9


def sample(seed, n, width):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(n, width)) @ rng.normal(size=(width, width)))]


def test_against_fractions(spark):
    rows = sample(1, 60, 10)
    odd = [(900, None), (901, []), (902, [1.0, None] * 5), (903, [float("nan")] * 10), (904, [float("-inf")] * 10), (905, [1.0] * 4)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows + odd], "vec_id bigint, embedding array<double>, whitened int, vector string, n int")
    got = whitening.whiten(frame.repartition(4)).collect()
    check(got, rows, 8)
    again = whitening.whiten(frame.repartition(1)).collect()  # the fit is exact, whatever the partitions
    assert {(r["vec_id"], r["component"], r["deviation"], r["explained"]) for r in got} == {(r["vec_id"], r["component"], r["deviation"], r["explained"]) for r in again}


def test_query_against_fractions(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.QUERIES["op13_whitening"](spark, folder).collect(), rows, 8)


def test_few_dimensions_and_repeated_rows(spark):
    line = [(i, [float(i % 7), 2.0 * (i % 7), 0.25]) for i in range(30)]
    frame = spark.createDataFrame(line + line + [(None, [3.0, 6.0, 0.25])] * 3, "vec_id bigint, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 63
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    same = spark.createDataFrame([(i, [1.5, 2.5]) for i in range(5)], frame.schema)
    for none in (same, frame.limit(0), spark.createDataFrame([(1, None)], frame.schema)):
        assert whitening.whiten(none).count() == 0


def test_sums_beyond_64_bits(spark):
    rows = [(i, [50_000.0 * (-1) ** i, float(i)]) for i in range(200)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    exact = dict(zip(range(200), brute(rows)[2]))
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None) for r in got)
    with pytest.raises(Exception, match="mean"):
        whitening.whiten(spark.createDataFrame([(0, [1e6, 0.0]), (1, [-1e6, 1.0])], "vec_id bigint, embedding array<double>")).collect()


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (9, 9), (20, 7)])
def test_factor_and_rotations(size, rank):
    rng = np.random.default_rng(size)
    half = rng.normal(size=(size, rank)) * 10.0 ** -np.arange(rank)
    a = half @ half.T
    factor = whitening.pivoted_cholesky(a)
    assert np.abs(factor @ factor.T - a).max() <= 1e-13 * np.abs(a).max()
    values, vectors = whitening.one_sided_jacobi(factor)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs((vectors * values) @ vectors.T - a).max() <= 1e-13 * np.abs(a).max()
    assert np.allclose(values[:rank], np.linalg.svd(half)[1][: len(values)] ** 2, rtol=1e-6)
