"""Removal of repeated 50-word passages by compaction of a de Bruijn graph of words.

An edge is a window of ``size`` words, its ends are the two windows of size - 1 words.
Only windows around a k-mer that more than one text holds become edges: the smallest hash
among the k-mers of a window (its minimizer) depends on the window's words alone, so a
window that repeats has a minimizer that repeats. Edges follow one another in each
document; where neither end branches, they compact into one path. Each occurrence of a
path is then verified by a 128-bit digest of the words at its source coordinates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.llm.common import batches, stored, windows_hash, word_hashes, words_of

SIZE = 50
SEED = 20


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` values, by doubling."""
    reach = 1
    while reach * 2 <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def minimizers(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The minimizer of every window of ``size`` words."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    return sliding_minimum(windows_hash(hashes, seed), size - seed + 1)


def _table(columns: dict, kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in columns.items()})


def key_of(sha: str) -> int:
    """64 bits of a text's digest: tells apart rows that repeat an id."""
    return int(sha[:16], 16) - (1 << 63)


def key_column(text: Column) -> Column:
    """``key_of`` the digest of a text's words, as a column."""
    words = F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""), " ")
    number = F.conv(F.substring(F.sha2(words, 256), 1, 16), 16, 10).cast("decimal(20)")
    return (number - F.lit(str(1 << 63)).cast("decimal(20)")).cast("bigint")


def digests(documents: DataFrame, size: int, seed: int) -> DataFrame:
    """Per document: ``doc_id, n_words, sha, anchors`` (its distinct minimizers)."""
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "sha": pa.string(), "key": pa.int64(), "anchors": pa.list_(pa.int64())}

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            columns: dict[str, list] = {k: [] for k in kinds}
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                found = np.unique(minimizers(word_hashes(words), size, seed)) if len(words) >= size else ()
                columns["doc_id"].append(name)
                columns["n_words"].append(len(words))
                columns["sha"].append(hashlib.sha256(b" ".join(words)).hexdigest())
                columns["key"].append(key_of(columns["sha"][-1]))
                columns["anchors"].append(np.array(found, np.uint64).view(np.int64))
            yield _table(columns, kinds)

    return documents.mapInArrow(read, "doc_id bigint, n_words bigint, sha string, key bigint, anchors array<bigint>")


def edges(texts: DataFrame, size: int, seed: int) -> DataFrame:
    """Windows with a shared minimizer: ``doc_id, key, pos, edge, before, after``.

    ``before`` and ``after`` are hashes of the adjoining words, 0 where there is no
    adjoining edge: where they differ between occurrences, the graph branches.
    """
    kinds = {"doc_id": pa.int64(), "key": pa.int64(), "pos": pa.int64(), "edge": pa.int64(), "before": pa.int64(), "after": pa.int64()}

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 256):
            parts: dict[str, list] = {k: [] for k in kinds}
            for name, key, text, shared in zip(*(batch[c].to_pylist() for c in ("doc_id", "key", "text", "anchors"))):
                words = words_of(text)
                if key_of(hashlib.sha256(b" ".join(words)).hexdigest()) != key:
                    continue  # another row with the same id
                hashes = word_hashes(words)
                known = np.isin(minimizers(hashes, size, seed).view(np.int64), np.array(shared, np.int64))
                at = np.flatnonzero(known)
                low = (hashes >> np.uint64(1)).astype(np.int64) | 1
                ahead = np.append(known[1:], False)[at]
                behind = np.append(False, known[:-1])[at]
                parts["doc_id"].append(np.full(len(at), name))
                parts["key"].append(np.full(len(at), key))
                parts["pos"].append(at)
                parts["edge"].append(windows_hash(hashes, size)[at].view(np.int64))
                parts["before"].append(np.where(behind, low[at - 1], 0))
                parts["after"].append(np.where(ahead, low[np.minimum(at + size, len(low) - 1)], 0))
            if parts["pos"]:
                yield _table({k: np.concatenate(v) for k, v in parts.items()}, kinds)

    return texts.mapInArrow(read, "doc_id bigint, key bigint, pos bigint, edge bigint, before bigint, after bigint")


def paths(found: DataFrame, size: int) -> DataFrame:
    """Compact unbranched runs: ``doc_id, key, path, start, length`` (length in words)."""
    ends = found.groupBy("edge").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        (F.min("before") != F.max("before")).alias("joins"), (F.min("after") != F.max("after")).alias("forks"),
    )
    marked = found.join(ends.filter("low < high"), "edge")
    order = W.partitionBy("doc_id", "key").orderBy("pos")
    new = (
        F.col("joins")
        | F.coalesce(F.lag("forks").over(order), F.lit(True))
        | (F.coalesce(F.lag("pos").over(order), F.lit(-9)) < F.col("pos") - 1)
    )
    numbered = marked.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    return numbered.groupBy("doc_id", "key", "run").agg(
        F.min_by("edge", "pos").alias("path"), F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + size).alias("length")
    )


def _with_texts(spans: DataFrame, documents: DataFrame) -> DataFrame:
    listed = spans.groupBy("doc_id", "key").agg(
        F.collect_list("path").alias("path"), F.collect_list("start").alias("start"), F.collect_list("length").alias("length")
    )
    return listed.join(documents, ["doc_id", "key"])


def verified(spans: DataFrame, documents: DataFrame) -> DataFrame:
    """Append ``d1, d2``: the digest of each occurrence's words, read at its coordinates."""

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 256):
            rows = []
            for name, key, path, start, length, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "key", "path", "start", "length", "text"))):
                words = words_of(text)
                if key_of(hashlib.sha256(b" ".join(words)).hexdigest()) != key:
                    continue
                for first, a, n in zip(path, start, length):
                    digest = xxhash.xxh3_128_digest(b" ".join(words[a : a + n]))
                    rows.append((name, key, first, a, n, *np.frombuffer(digest, np.int64).tolist()))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "key", "path", "start", "length", "d1", "d2"],
            )

    return _with_texts(spans, documents).mapInArrow(
        read, "doc_id bigint, key bigint, path bigint, start bigint, length bigint, d1 bigint, d2 bigint"
    )


def without(spans: DataFrame, documents: DataFrame) -> DataFrame:
    """``doc_id, key, removed, kept_sha256`` of documents from which spans are cut."""

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 256):
            rows = []
            for name, key, start, length, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "key", "start", "length", "text"))):
                words = words_of(text)
                if key_of(hashlib.sha256(b" ".join(words)).hexdigest()) != key:
                    continue
                gone = np.zeros(len(words), bool)
                for a, n in zip(start, length):
                    gone[a : a + n] = True
                kept = b" ".join(word for word, cut in zip(words, gone.tolist()) if not cut)
                rows.append((name, key, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*dict.fromkeys(rows))) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "key", "removed", "kept_sha256"]
            )

    return _with_texts(spans, documents).mapInArrow(read, "doc_id bigint, key bigint, removed bigint, kept_sha256 string")


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, seed: int = SEED) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256``.

    A word goes if a window of ``size`` words over it also starts in a document with a
    smaller id. Null texts have no words; a null id counts as larger than all others; rows
    that repeat an id are documents of their own, none smaller than the other.
    """
    own = documents.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit((1 << 63) - 1)).alias("doc_id"), F.col(text).alias("text"))
    keyed = own.withColumn("key", key_column(F.col("text")))
    rows = stored(digests(own, size, seed))
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("first"))
    placed = stored(rows.drop("anchors").join(firsts, "sha"))
    # Copies of a whole text need no windows: all of it starts in the first one.
    own_anchors = rows.join(firsts.select("sha", F.col("first").alias("doc_id")), ["sha", "doc_id"])
    own_anchors = own_anchors.select("doc_id", "key", F.explode("anchors").alias("anchor"))
    shared = own_anchors.groupBy("anchor").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b")
    chosen = own_anchors.join(shared.select("anchor"), "anchor").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("anchors"))
    # Rows that repeat an id and a text give their windows once, and all get the result.
    texts = stored(chosen.join(keyed, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]))
    found = stored(edges(texts, size, seed))
    texts = texts.drop("anchors")
    spans = stored(verified(stored(paths(found, size)), texts).dropDuplicates(["doc_id", "key", "start"]))
    first = spans.groupBy("path", "length", "d1", "d2").agg(F.min("doc_id").alias("first"))
    repeats = spans.join(first, ["path", "length", "d1", "d2"]).filter("first < doc_id")
    cut = stored(without(repeats, texts).dropDuplicates(["doc_id", "key"]))
    empty = hashlib.sha256(b"").hexdigest()
    copy = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= size)
    return placed.join(cut, ["doc_id", "key"], "left").select(
        F.nullif(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
