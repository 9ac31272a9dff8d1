"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.llm.common import WORD, stored
from tickloom.operators.keys import number_rows

WEIGHTS = (5, 2, 1)
MOST = 3.0


def word_count(text: Column) -> Column:
    """Words of the whole text; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """One row per source: size, target and its first row number.

    Sources take the weights in turn by code point, null last. A source never gets more
    than ``most`` times its size; what is left over is shared by weight among the others.
    Ordered by size per weight the capped sources come first, so prefix sums decide which
    are capped: the level rises up to the first uncapped one and falls after it. These
    windows run over one row per source.
    """
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.min("row").alias("first_row")
    )
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = most * F.col("source_size")
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    shared = F.max(F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))).over(
        everything
    )
    return (
        sources.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("level", level)
        .withColumn("target", F.least(F.col("cap"), F.col("weight") * F.coalesce(shared, F.lit(0.0))))
        .select("source", "source_size", "first_row", "target")
    )


def offset_of(source: Column, seed: int) -> Column:
    """The random start of a source in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = 17,
    draws: int = 16,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Copies of each document: ``doc_id, source, size, source_size, target, copies, taken``.

    Every document expects target / source_size copies. Within a source these are summed
    up in the order (size, doc_id), a random start is added, and a document is emitted
    once per integer crossed. That order spreads sizes evenly over what is taken. Row
    numbers come from range partitions, so a source may hold any share of the rows.
    Empty texts have size 0 and add nothing; rows with equal ids are separate documents.
    Columns named in ``carry`` are appended; they decide between rows that are otherwise equal.
    """
    sized = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *carry
    )
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc_nulls_last(), *carry]
    numbered, _ = number_rows(stored(sized), "row", order)
    numbered = stored(numbered)
    targets = source_targets(numbered, weights, most).select(
        F.col("source").alias("of_source"), "source_size", "first_row", "target"
    )
    joined = numbered.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    position = F.col("row") - F.col("first_row")

    def crossed(start: Column) -> Column:
        count = F.floor((position + 1) * expected + start) - F.floor(position * expected + start)
        return F.least(count, F.lit(int(most))).cast("bigint")

    # A few random starts are tried on every source; the one nearest to its target counts.
    starts = [offset_of(F.col("source"), seed + draw) for draw in range(draws)]
    sums = joined.groupBy("source").agg(
        F.first("target").alias("t"), *[F.sum(crossed(s) * F.col("size")).alias(f"s{i}") for i, s in enumerate(starts)]
    )
    tried = F.array(*[F.struct(F.abs(F.col(f"s{i}") - F.col("t")).alias("off"), s.alias("start")) for i, s in enumerate(starts)])
    chosen = sums.select(F.col("source").alias("started"), F.array_min(tried)["start"].alias("start"))
    joined = joined.join(chosen, F.col("source").eqNullSafe(F.col("started")))
    copies = crossed(F.col("start"))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"), *carry,
    )
