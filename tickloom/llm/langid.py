"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import batches

BUCKETS = 1 << 14
CHUNK = 1 << 18
MAX_LANGUAGES = 4096
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """``log_prob`` has one row per bucket and one column per language."""

    languages: list[str]
    prior: np.ndarray
    log_prob: np.ndarray


def ngram_buckets(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of the 2- and 3-grams of the lower-cased whole text, in bounded pieces."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for start in range(0, max(len(codes) - 2, 1), CHUNK):
        part = codes[start : start + CHUNK + 2]
        pair = part[:-1] * np.uint32(0x9E3779B1) + part[1:] * np.uint32(0x85EBCA6B)
        yield (pair[: CHUNK] * np.uint32(0xC2B2AE35)) >> shift
        triple = pair[:-1] * np.uint32(0x27D4EB2F) + part[2:] * np.uint32(0x165667B1)
        yield (triple * np.uint32(0xC2B2AE35) + np.uint32(0x1B873593)) >> shift


def fit(training: DataFrame, text: str, lang: str, buckets: int = BUCKETS) -> LanguageModel:
    """Learn from every row with a text and a label.

    Tasks count n-grams per language; only languages x buckets sums reach the driver. More
    than ``MAX_LANGUAGES`` distinct labels are refused, as that is no language column.
    """

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, total in sums.items():
                hit = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([name] * (len(hit) + 1), pa.string()),
                        "bucket": pa.array(np.append(hit, -1), pa.int64()),
                        "n": pa.array(np.append(total[hit], rows[name]), pa.int64()),
                    }
                )
            sums.clear()
            rows.clear()

        for batch in batches(source):
            for value, name in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                total = sums.setdefault(name, np.zeros(buckets, np.int64))
                rows[name] = rows.get(name, 0) + 1
                for found in ngram_buckets(value, buckets):
                    total += np.bincount(found, minlength=buckets)
            if len(sums) > 64:
                yield from flush()
        yield from flush()

    labelled = training.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    counted = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per language with its sums in an array: the matrix, bounded by its shape.
    rows = (
        sums.groupBy("lang")
        .agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
        .orderBy("lang")
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: not a language column")
    counts = np.zeros((buckets, len(rows)))
    documents = np.zeros(len(rows))
    for column, row in enumerate(rows):
        at, n = np.array(row["bucket"]), np.array(row["n"], float)
        counts[at[at >= 0], column] = n[at >= 0]
        documents[column] = n[at < 0].sum()
    log_prob = np.log(counts + 1) - np.log(counts.sum(0) + buckets)
    prior = np.log(documents / documents.sum()) if rows else np.zeros(0)
    return LanguageModel([row["lang"] for row in rows], prior, log_prob.astype(np.float32))


def predict(documents: DataFrame, text: str, model: LanguageModel) -> DataFrame:
    """Append ``lang_pred`` and ``score`` (posterior probability of the prediction).

    Null texts, texts without a letter and a model without languages give ``und`` and 0.
    Ties go to the language that sorts first.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        buckets = len(known.log_prob)
        for batch in batches(source):
            labels, scores = [], []
            for value in batch[names.index(text)].to_pylist():
                if not known.languages or not value or not any(map(str.isalpha, value)):
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = known.prior.copy()
                for found in ngram_buckets(value, buckets):
                    times = np.bincount(found, minlength=buckets) if len(found) > 4096 else None
                    if times is None:
                        total += known.log_prob[found].sum(0, dtype=float)
                    else:
                        total += times @ known.log_prob
                best = int(total.argmax())
                labels.append(known.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(score, f"{fields}, lang_pred string, score double")
