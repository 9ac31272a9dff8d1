"""Toxicity: a word classifier regularised by swapped identity terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import batches, stored

# Identity terms; a term is swapped for the next of its line.
IDENTITY = [
    "women men".split(),
    "woman man".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "muslim christian jewish hindu buddhist atheist".split(),
    "gay lesbian straight bisexual transgender".split(),
    "black white asian latino".split(),
    "immigrants refugees natives foreigners".split(),
    "deaf blind disabled".split(),
    "old young".split(),
]
SWAP = {term: line[(i + 1) % len(line)] for line in IDENTITY for i, term in enumerate(line)}
TOKEN = re.compile(r"[^\W\d_]+")
MAX_LABELLED = 20_000
VOCABULARY = 2_000
SURPRISE = 20.0
BEGINNINGS = (4, 5, 6)
MIN_DOCUMENTS = 5
BLOCK = 1000
# Ranges that the hashes of ids are counted in: 2 ** RANGE_BITS.
RANGE_BITS = 12


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float


def words_of(text: str | None) -> set[str]:
    return set(TOKEN.findall(text.lower())) if text else set()


def tokens(text: str | None) -> set[str]:
    """Different words of the text, and the beginnings of longer ones, marked with *."""
    return features(words_of(text))


def features(words: set[str]) -> set[str]:
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in BEGINNINGS))


def swapped(found: set[str]) -> set[str]:
    return {SWAP.get(word, word) for word in found}


def train(x: np.ndarray, y: np.ndarray, change: np.ndarray, penalty: float, ridge: float, steps: int = 50) -> tuple[np.ndarray, float]:
    """Logistic regression with a penalty on the squared score change of swapped rows (Newton)."""
    n, width = x.shape
    weights = np.zeros(width + 1)
    extra = np.zeros((width + 1, width + 1))
    for at in range(0, len(change), BLOCK):
        part = change[at : at + BLOCK].astype(float)
        extra[:width, :width] += penalty * part.T @ part / len(change)
    extra[range(width), range(width)] += ridge / n
    extra[width, width] += 1e-9
    for _ in range(steps):
        gradient, hessian = extra @ weights, extra.copy()
        for at in range(0, n, BLOCK):
            design = np.ones((len(y[at : at + BLOCK]), width + 1))
            design[:, :width] = x[at : at + BLOCK]
            p = 1 / (1 + np.exp(-design @ weights))
            gradient += design.T @ (p - y[at : at + BLOCK]) / n
            hessian += design.T @ (design * (p * (1 - p))[:, None]) / n
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights[:width], float(weights[width])


def chosen(labelled: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hash of their id.

    The hashes are counted in ranges first. Only rows up to the range that holds the last
    one wanted are moved and sorted, however many have a label.
    """
    place = F.xxhash64("doc_id")
    part = F.shiftright(place, 64 - RANGE_BITS)
    total, last = 0, None
    for row in labelled.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        total, last = total + row["n"], row["part"]
        if total >= most:
            break
    if total >= most and last is not None:
        labelled = labelled.filter(part <= last)
    return labelled.orderBy(place, "doc_id", "text").limit(most)


def fit(
    labelled: DataFrame,
    max_labelled: int = MAX_LABELLED,
    vocabulary: int = VOCABULARY,
    penalty: float = 10.0,
    ridge: float = 0.05,
) -> ToxicityModel:
    """Learn from ``doc_id, text, toxic`` rows with a label.

    At most ``max_labelled`` rows are used, those with the smallest hash of their id, and
    the ``vocabulary`` words that separate the labels best (chi-square), besides identity
    terms. One class only, or no rows: a constant score.
    """
    usable = labelled.filter("toxic IS NOT NULL AND text IS NOT NULL")
    taken = chosen(usable, max_labelled)

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            plain = [words_of(t) for t in batch["text"].to_pylist()]
            found = [sorted(features(words)) for words in plain]
            # Words are swapped first, so that beginnings follow; null without identity terms.
            others = [sorted(features(swapped(words))) if words & SWAP.keys() else None for words in plain]
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"].cast(pa.int32()), pa.array(found, kind), pa.array(others, kind)], ["toxic", "words", "others"]
            )

    sample = stored(taken.select("toxic", "text").repartition(32).mapInArrow(read, "toxic int, words array<string>, others array<string>"))
    totals = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return ToxicityModel({}, 20.0 if bad else -20.0)
    words = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")
    )
    expected = F.col("n") * bad / (bad + good)
    surprise = (F.col("bad") - expected) ** 2 / expected
    best = (
        words.filter(((F.col("n") >= MIN_DOCUMENTS) & (surprise >= SURPRISE)) | F.col("word").isin(list(SWAP)))
        .orderBy(F.col("word").isin(list(SWAP)).desc(), surprise.desc(), "word")
        .limit(vocabulary)
        .collect()
    )
    index = {row["word"]: i for i, row in enumerate(best)}
    listed = F.array(*[F.lit(w) for w in index]) if index else F.array().cast("array<string>")
    narrow = sample.select("toxic", F.array_intersect("words", listed).alias("words"), F.array_intersect("others", listed).alias("others"))
    x = np.zeros((bad + good, len(index)), np.int8)
    y = np.zeros(bad + good)
    change = []
    for at, row in enumerate(narrow.toLocalIterator()):
        y[at] = row["toxic"]
        here = set(row["words"])
        x[at, [index[w] for w in here]] = 1
        other = here if row["others"] is None else set(row["others"])
        if other != here:
            line = np.zeros(len(index), np.int8)
            line[[index[w] for w in here]] += 1
            line[[index[w] for w in other]] -= 1
            change.append(line)
    weights, bias = train(x, y, np.array(change), penalty, ridge)
    return ToxicityModel({w: float(weights[i]) for w, i in index.items()}, bias)


def score(documents: DataFrame, text: str, model: ToxicityModel) -> DataFrame:
    """Append ``score`` (0 to 1, higher: toxic likelier); null and empty texts get the bias."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns

    def apply(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches(source):
            scores = []
            for value in batch[names.index(text)].to_pylist():
                total = known.bias
                if value:
                    total += sum(map(known.weights.__getitem__, known.weights.keys() & tokens(value)))
                scores.append(float(1 / (1 + np.exp(-np.clip(total, -30, 30)))))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(apply, f"{fields}, score double")
