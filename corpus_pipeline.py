"""From raw documents to training sequences: five stages, each over what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import lines, mixing, ngrams, packing, toxicity
from tickloom.llm.common import stored
from tickloom.llm.queries import VOCABULARY, toxicity_model


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.3."""
    scored = toxicity.score(docs, "text", toxicity_model(spark, sf_dir))
    return scored.filter("score < 0.3").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat earlier ones; a document that loses all its lines goes."""
    kept = lines.dedup(docs)
    kept = kept.filter("n_removed = 0 OR n_removed < n_lines")
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """Append ``_row``: ids may be null or repeated, row numbers are not. Stored, so that they stay."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    rows = numbered(docs)
    groups = ngrams.near_duplicates(rows, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    # Null ids come last; of rows with the smallest id one is taken, by a hash of its text.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), "_row")
    firsts = rows.select("_row", place.alias("place")).join(groups, "_row").groupBy("component_id").agg(F.min("place")["_row"].alias("_row"))
    return rows.join(firsts, "_row", "left_semi").select(*docs.columns)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = numbered(docs)
    taken = mixing.mix(rows, carry=("_row",)).filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return rows.join(taken, "_row").select(*docs.columns)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    cut = packing.pieces(docs, public_tokenizers.path(VOCABULARY))
    return packing.pack(stored(cut))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources", to_target_weights),
    ("best-fit packing", into_sequences),
]
# Classifier, similarity joins and tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs)
    return docs
