"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import clusters, langid, licenses, lines, mixing, neighbours, ngrams, packing, quality, substring, token_files, toxicity, whitening
from tickloom.llm.common import read, remainder, stored, table_path
from tickloom.session import use_session_defaults

VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
WORD_END = 1


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-text license of every document and the licenses of its notice lines."""
    known = F.broadcast(licenses.known_digests(spark))  # one row per text of a fixed list
    return licenses.report(read(spark, folder, "documents"), known)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.remove_repeats(read(spark, folder, "documents"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents"))


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.near_duplicates(read(spark, folder, "documents"))


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(read(spark, folder, "embeddings"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 3) == 1
    model = langid.fit(documents.filter(~held_out), "text", "lang")
    found = langid.predict(documents.select("doc_id", "text"), "text", model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op9_pack(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    cut = packing.pieces(documents, public_tokenizers.path(VOCABULARY))
    return packing.pack(stored(cut))


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.ToxicityModel:
    """Learnt from the labelled rows of ``documents`` that are not held out."""
    labels = read(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = read(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")
    return toxicity.fit(labelled.filter(remainder("doc_id", 4) != 2))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, "text", toxicity_model(spark, folder))
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.with_inertia(clusters.cluster(read(spark, folder, "embeddings")))


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files written below the checkpoint folder, and every document read back from them."""
    path = table_path(spark, "token-files")
    token_files.write_tokens(read(spark, folder, "documents"), path, public_tokenizers.path(WORD_VOCABULARY), WORD_END)
    return token_files.encoded(spark, path)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))


def _own_session(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(use_session_defaults(spark), folder)

    run.__doc__ = query.__doc__
    return run


QUERIES = {
    query.__name__: _own_session(query)
    for query in (
        op1_license_scan, op2_substring_dedup, op3_mix_sources, op4_quality_divergence, op5_ngram_join,
        op6_nearest, op7_language, op8_line_dedup, op9_pack, op10_toxicity, op11_clusters, op12_token_files, op13_whitening,
    )
}
