"""Neighbour graph with several leaves and rounds, vectors of other lengths, other columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import neighbours


@pytest.fixture(scope="module")
def vectors():
    return np.random.default_rng(4).normal(size=(900, 10)) * np.random.default_rng(5).uniform(0.5, 2, size=(900, 1))


def test_rounds_and_search_find_the_nearest(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    nodes = neighbours.nodes_of(spark.createDataFrame(rows, "vec_id bigint, vector array<double>"))
    graph = neighbours.build(nodes, degree=16, trees=2, leaf=60)
    edges = graph.collect()
    assert max(np.bincount([e["src"] for e in edges])) == 16
    assert len({(e["src"], e["dst"]) for e in edges}) == len(edges)
    assert all(e["src"] != e["dst"] for e in edges)
    queries = nodes.filter("node % 30 = 0").select(F.col("node").alias("query"), "vector")
    got = {}
    for r in neighbours.search(queries, nodes, graph, 11, pool=48).collect():
        got.setdefault(r["query"], {})[r["node"]] = r["score"]
    hits = 0
    for query, found in got.items():
        scores = vectors @ vectors[query]
        assert len(found) == 11
        assert all(abs(scores[node] - score) < 1e-9 for node, score in found.items())
        hits += len(set(found) & set(np.argsort(-scores)[:11].tolist()))
    assert len(got) == 30
    assert hits / (11 * 30) >= 0.95


def test_heavy_blocks_are_split(spark, vectors, monkeypatch):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors[:300])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = {tuple(r) for r in neighbours.nearest_neighbours(frame).collect()}
    monkeypatch.setattr(neighbours, "GROUP_PAIRS", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    assert {tuple(r) for r in neighbours.nearest_neighbours(frame).collect()} == whole


def test_other_lengths_huge_components_and_other_columns(spark):
    rows = [(20 * i, [1e200 * (i + 1), -1e200, 1.0], 0, 0.5, "x") for i in range(5)]
    rows += [(100, [1.0, 2.0], 1, 0.5, "x"), (120, [3.0], 1, None, None), (140, [], 1, None, None), (160, [None, 1.0, 1.0], 1, None, None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node int, score double, query string")
    got = neighbours.nearest_neighbours(frame).collect()
    assert {r["query_id"] for r in got} == {r["vec_id"] for r in got} == {0, 20, 40, 60, 80}
    assert len(got) == 20


def test_unusable_single_and_equal_vectors(spark):
    near = lambda rows: neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert near([(0, None), (20, [0.0, 0.0]), (None, [1.0, 2.0])]).count() == 0
    assert near([(20, [1.0, 2.0])]).count() == 0
    got = near([(i, [1.0, 2.0]) for i in range(41)]).collect()
    for query in (0, 20, 40):
        assert sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == query) == list(enumerate([i for i in range(41) if i != query][:20], 1))
