"""Approximate nearest neighbours: NN-descent graph in Spark joins, greedy graph search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tickloom.llm.common import discard, mixed, stored

NEAREST = 20
# Neighbours a node keeps, and how many it tells each neighbour of per round.
DEGREE = 32
TELL = 8
# Rounds go on until less than this share of the edges is new.
SETTLED = 0.05
# Random trees of the first graph, nodes of a leaf, neighbours taken from one.
TREES = 8
LEAF = 1600
LEAF_BEST = 16
# Nodes from which the cutting values of the trees are taken.
SAMPLE = 4096
# Best nodes a search keeps; it ends when all of them have been visited.
POOL = 192
ENTRIES = 8
# Nodes that lie together when they are scored, pairs scored in one task's group.
BLOCK = 4096
GROUP_PAIRS = 4_000_000
EDGE = "src bigint, dst bigint, score float"


def best_per(rows: DataFrame, key: str, count: int, other: str) -> DataFrame:
    """The ``count`` best scored rows of a key, one per ``other``; ties to the smaller."""
    order = W.partitionBy(key).orderBy(F.desc("score"), F.asc(other))
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= count).drop("_n")


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vector`` without null, empty, zero and non-finite vectors, and without those
    that differ from the commonest length (the smaller one of equally common)."""
    vector = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), vector.alias("vector"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", sound) & F.exists("vector", lambda x: x != 0)
    )
    common = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return rows.filter(F.size("vector") == (common["width"] if common else 0))


def nodes_of(rows: DataFrame) -> DataFrame:
    """One node per different vector: ``node`` (its smallest id), ``vector`` and ``point``.

    ``point`` is the vector over the largest length, in single precision, with one more
    component that lifts all of them to length 1, so that a larger inner product is a smaller
    distance and the graph is one of true neighbours.
    """
    different = stored(rows.groupBy("vector").agg(F.min("vec_id").alias("node")))
    size = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    largest = different.agg(F.max(size).alias("m")).first()["m"] or 1.0
    scaled = different.withColumn("scaled", F.transform("vector", lambda x: x / F.lit(largest)))
    squares = F.aggregate("scaled", F.lit(0.0), lambda a, x: a + x * x)
    most = scaled.agg(F.max(squares).alias("m")).first()["m"] or 1.0
    lift = F.sqrt(F.greatest(F.lit(most) - squares, F.lit(0.0)))
    point = F.transform(F.concat("scaled", F.array(lift)), lambda x: (x / F.lit(most**0.5)).cast("float"))
    return stored(scaled.select("node", "vector", point.alias("point")))


def matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def _inner_best(ids: np.ndarray, points: np.ndarray, count: int, worst: np.ndarray | None = None, fresh: np.ndarray | None = None) -> list[np.ndarray]:
    """``src, dst, score``: for each of the points its ``count`` best others among them, if
    given only those above its ``worst`` and pairs of which one is ``fresh``."""
    count = min(count, len(ids) - 1)
    found = []
    for first in range(0, len(ids), 512):
        rows = np.arange(first, min(first + 512, len(ids)))
        scores = points[rows] @ points.T
        scores[rows - first, rows] = -np.inf
        if fresh is not None:
            scores[~(fresh[rows][:, None] | fresh)] = -np.inf
        if worst is not None:
            scores[scores <= worst[rows][:, None]] = -np.inf
        top = np.argpartition(-scores, count - 1, axis=1)[:, :count]
        best = np.take_along_axis(scores, top, 1)
        good = best > -np.inf
        found.append([np.repeat(ids[rows], good.sum(1)), ids[top[good]], best[good]])
    return [np.concatenate(part) for part in zip(*found)]


def _edges(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    src, dst, score = (np.concatenate(part) for part in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
    arrays = [pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(score, pa.float32())]
    return pa.RecordBatch.from_arrays(arrays, ["src", "dst", "score"])


def first_graph(nodes: DataFrame, count: int, degree: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """Neighbours within leaves of random trees, whose planes halve a sample; a leaf that is
    too full all the same is dealt out further."""
    sample = nodes.select("point").orderBy(F.xxhash64("node")).limit(SAMPLE).toArrow()
    sample = matrix(sample["point"])
    bits = max(0, int(np.ceil(np.log2(max(count / leaf, 1)))))
    trees = trees if bits else 1
    planes = np.random.default_rng(seed).normal(size=(trees, bits, sample.shape[1])).astype(np.float32)
    cuts = [np.median(sample @ planes[tree].T, axis=0) for tree in range(trees)]

    def leaves(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            points = matrix(batch["point"])
            for tree in range(trees):
                code = ((points @ planes[tree].T > cuts[tree]) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(points), np.int64)
                columns = [pa.array(np.full(len(points), tree, np.int32)), pa.array(code), batch["node"], batch["point"]]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "code", "node", "point"])

    placed = stored(nodes.select("node", "point").mapInArrow(leaves, "tree int, code bigint, node bigint, point array<float>"))
    sizes = placed.groupBy("tree", "code").agg(F.count("*").alias("size"))
    dealt = placed.join(sizes, ["tree", "code"]).withColumn(
        "part", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("size") / (2 * leaf)))
    )

    def join(table: pa.Table) -> pa.Table:
        ids = table["node"].to_numpy()
        parts = [_inner_best(ids, matrix(table["point"]), LEAF_BEST)] if len(ids) > 1 else []
        return pa.Table.from_batches([_edges(parts)])

    found = dealt.select("tree", "code", "part", "node", "point").groupBy("tree", "code", "part").applyInArrow(join, EDGE)
    found = found.groupBy("src", "dst").agg(F.max("score").alias("score"))
    graph = stored(best_per(found, "src", degree, "dst").withColumn("fresh", F.lit(True)))
    discard(placed)
    return graph


def backward(graph: DataFrame, degree: int) -> DataFrame:
    """The edges of a graph the other way round, the best ``degree`` of a node."""
    turned = graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "score", "fresh")
    return best_per(turned, "src", degree, "dst")


def build(nodes: DataFrame, degree: int = DEGREE, trees: int = TREES, leaf: int = LEAF, settled: float = SETTLED, seed: int = 7) -> DataFrame:
    """The neighbour graph ``src, dst, score, fresh``: every node's ``degree`` best, as found.

    NN-descent: in every round each node brings its neighbours, both ways, together, and
    tells each the best of the others that are better than its worst edge. Pairs of which
    neither came by an edge of the last round have met before. It ends when less than
    ``settled`` of the edges are new. A node sees at most 2 * degree others, the best in
    either direction, and sends on fixed numbers, so hubs do not grow.
    """
    count = nodes.count()
    if count < 2:
        return nodes.sparkSession.createDataFrame([], EDGE + ", fresh boolean")
    graph = first_graph(nodes, count, degree, trees, leaf, seed)

    def meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            around = batch["around"].flatten()
            ids, fresh, worst = (around.field(name).to_numpy(zero_copy_only=False) for name in ("node", "fresh", "worst"))
            points = matrix(around.field("point"))
            ends = np.cumsum(pc.list_value_length(batch["around"]).to_numpy())
            groups = (slice(start, end) for start, end in zip(np.r_[0, ends], ends) if end - start > 1)
            yield _edges([_inner_best(ids[g], points[g], TELL, worst[g], fresh[g]) for g in groups])

    while count > leaf and graph.filter("fresh").count() >= settled * graph.count():
        both = graph.union(backward(graph, degree)).groupBy("src", "dst").agg(F.max("fresh").alias("fresh"))
        full = F.when(F.count("*") >= degree, F.min("score")).otherwise(F.lit(float("-inf")).cast("float"))
        worst = graph.groupBy(F.col("src").alias("node")).agg(full.alias("worst"))
        known = nodes.select("node", "point").join(worst, "node", "left").fillna(float("-inf"), "worst")
        near = both.join(known.withColumnRenamed("node", "dst"), "dst")
        met = near.groupBy("src").agg(
            F.max("fresh").alias("any"), F.collect_list(F.struct(F.col("dst").alias("node"), "point", "fresh", "worst")).alias("around")
        )
        told = met.filter("any").select("around").mapInArrow(meet, EDGE)
        merged = graph.withColumn("fresh", F.lit(False)).union(told.withColumn("fresh", F.lit(True)))
        merged = merged.groupBy("src", "dst").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
        last, graph = graph, stored(best_per(merged, "src", degree, "dst"))
        discard(last)
    return graph


def exact(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Inner products in double precision."""
    for frame in source:
        scores = [float(np.dot(x, y)) for x, y in zip(frame["_v"], frame["vector"])]
        yield frame[["query", "node"]].assign(score=np.array(scores, float))


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, nearest: int, pool: int = POOL) -> DataFrame:
    """Greedy search for ``query, vector`` rows: ``query, node, score``, best ``nearest`` nodes.

    A query starts at its best entries (a sample of nodes that grows with the root of their
    number) and at its own node, if it is in the graph. Every step visits the neighbours of
    all of its best ``pool`` nodes not yet visited, until there are none. Nodes are scored in
    blocks, to which a query's vector goes once, in single precision; the best are scored
    again in double precision. A block that many queries visit is split by query.
    """
    count = nodes.count()
    entries = nodes.orderBy(F.xxhash64("node")).limit(256 + 4 * int(count**0.5)).select("node", "point").toArrow()
    ids, grid = entries["node"].to_numpy(), matrix(entries["point"])[:, :-1]
    blocks = max(1, -(-count // BLOCK))
    block_of = lambda node: (mixed(node.view(np.uint64)) % np.uint64(blocks)).astype(np.int32)

    def place(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array(block_of(batch["node"].to_numpy())), *batch.columns], ["block", "node", "point"])

    def enter(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            query, points = batch["query"].to_numpy(), matrix(batch["at"])
            for first in range(0, len(query), 512):
                scores = points[first : first + 512] @ grid.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :ENTRIES]
                columns = [np.repeat(query[first : first + 512], top.shape[1]), ids[top].ravel(), np.take_along_axis(scores, top, 1).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "node", "score"])

    def spread(table: pa.Table) -> pa.Table:
        node = np.unique(table["around"].combine_chunks().flatten().to_numpy())
        block = block_of(node)
        order = np.argsort(block, kind="stable")
        at, first = np.unique(block[order], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(node)].astype(np.int32)), pa.array(node[order]))
        query = pa.array(np.full(len(at), table["query"][0].as_py(), np.int64))
        return pa.table({"query": query, "block": pa.array(at), "nodes": lists})

    def score(visits: pa.Table, block: pa.Table) -> pa.Table:
        known = block["node"].to_numpy()
        order = np.argsort(known)
        known, points, at = known[order], matrix(block["point"])[order, :-1], matrix(visits["at"])
        wanted = visits["nodes"].combine_chunks()
        node, query = wanted.flatten().to_numpy(), visits["query"].to_numpy()
        row = np.repeat(np.arange(len(query)), pc.list_value_length(wanted).to_numpy())
        floor, place = visits["floor"].to_numpy()[row], np.searchsorted(known, node)
        scores = np.empty(len(node), np.float32)
        for first in range(0, len(node), 1 << 16):
            part = slice(first, first + (1 << 16))
            scores[part] = np.einsum("ij,ij->i", points[place[part]], at[row[part]])
        good = scores > floor
        return pa.table({"query": pa.array(query[row[good]]), "node": pa.array(node[good]), "score": pa.array(scores[good])})

    placed = stored(nodes.select("node", "point").mapInArrow(place, "block int, node bigint, point array<float>"))
    edges = graph.union(backward(graph, DEGREE)).select("src", "dst").distinct()
    walk = stored(edges.groupBy("src").agg(F.collect_list("dst").alias("around")))
    size = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    queries = stored(queries.select("query", "vector", F.transform("vector", lambda x: (x / size).cast("float")).alias("at")))
    own = queries.join(nodes, F.col("query") == F.col("node"), "left_semi")
    own = own.select("query", F.col("query").alias("node"), F.lit(float("inf")).cast("float").alias("score"))
    start = queries.select("query", "at").mapInArrow(enter, "query bigint, node bigint, score float").union(own)
    start = start.groupBy("query", "node").agg(F.max("score").alias("score"))
    best = stored(start.withColumn("seen", F.lit(False)))
    while not best.filter("NOT seen").isEmpty():
        full = F.when(F.count("*") >= pool, F.min("score")).otherwise(F.lit(float("-inf")).cast("float"))
        floors = best.groupBy("query").agg(full.alias("floor"))
        steps = best.filter("NOT seen").select("query", F.col("node").alias("src")).join(walk, "src").select("query", "around")
        visits = stored(steps.groupBy("query").applyInArrow(spread, "query bigint, block int, nodes array<bigint>"))
        split = F.ceil(F.sum(F.size("nodes")) / GROUP_PAIRS).cast("int")
        splits = stored(visits.groupBy("block").agg(split.alias("split")))
        asked = visits.join(queries.select("query", "at").join(floors, "query"), "query").join(splits, "block")
        asked = asked.withColumn("slice", F.pmod(F.xxhash64("query"), F.col("split")).cast("int")).drop("split")
        there = placed.join(splits, "block").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("split") - 1))).drop("split")
        met = asked.groupBy("block", "slice").cogroup(there.groupBy("block", "slice")).applyInArrow(score, "query bigint, node bigint, score float")
        found = best.withColumn("seen", F.lit(True)).union(met.withColumn("seen", F.lit(False)))
        found = found.groupBy("query", "node").agg(F.max("score").alias("score"), F.max("seen").alias("seen"))
        last, best = best, stored(best_per(found, "query", pool, "node"))
        for table in (last, visits, splits):
            discard(table)
    close = best_per(best.select("query", "node", "score"), "query", 2 * nearest, "node").select("query", "node")
    pairs = close.join(nodes.select("node", F.col("vector").alias("_v")), "node").join(queries.select("query", "vector"), "query")
    scored = pairs.select("query", "node", "_v", "vector").mapInPandas(exact, "query bigint, node bigint, score double")
    return best_per(scored, "query", nearest, "node")


def nearest_neighbours(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, nearest: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest other rows of every row whose id is
    divisible by ``every``, by inner product.

    Equal vectors are one node with its ``nearest`` + 1 smallest ids, enough for any answer.
    Unusable vectors (see ``usable``) and null ids take no part, other columns neither. Repeated ids count once
    for each different vector.
    """
    rows = stored(usable(vectors, vec_id, embedding).dropDuplicates(["vec_id", "vector"]))
    nodes = nodes_of(rows)
    graph = build(nodes) if not nodes.isEmpty() else None
    owner = stored(rows.join(nodes.select("node", "vector"), "vector").select("vec_id", "node"))
    members = best_per(owner.withColumn("score", F.lit(0.0)), "node", nearest + 1, "vec_id").drop("score")
    asked = owner.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    if graph is None:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    distinct = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("query"), "vector")
    found = stored(search(distinct, nodes, graph, nearest + 1).join(members, "node").select("query", "vec_id", "score"))
    found = stored(best_per(found, "query", nearest + 1, "vec_id"))
    answers = asked.join(found, "query").filter("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
