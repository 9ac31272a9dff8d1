"""Groups of near copies and of similar, unlinked texts: rounds of leaders and the pairs left after them."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tickloom.llm import ngrams
from tickloom.llm.setjoin import repeated


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for size, changes in ((200, 5), (120, 4), (60, 2), (30, 1)):
        base = rng.choices(vocabulary, k=size)
        texts += [edited(rng, base, rng.randint(0, changes)) for _ in range(40)]
    passage = rng.choices(vocabulary, k=60)
    # A passage that many texts share, more or less than what links them.
    texts += [passage + rng.choices(vocabulary, k=rng.randint(0, 60)) for _ in range(60)]
    chain = rng.choices(vocabulary, k=100)
    for _ in range(12):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [texts[k] for k in (0, 41, 90, 90, 90)]
    rng.shuffle(texts)
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


def expected(rows):
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0:
                x, y = top(a), top(b)
                group[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


@pytest.mark.parametrize("rounds", [ngrams.ROUNDS, 0])
def test_groups_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(ngrams, "ROUNDS", rounds)
    rows = corpus()
    found = ngrams.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == expected(rows)


def test_null_ids_stay_alone(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text), (5, text), (7, text + " end"), (None, text), (8, None), (9, "")]
    found = ngrams.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None)
    assert got == [(5, 26, 5), (7, 27, 5), (8, 0, 8), (9, 0, 9)]
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None, None]


def test_filter_misses_no_repeated_signature(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(-(1 << 63), 1 << 63, 5000)
    twice = values[:700]
    table = spark.createDataFrame([(int(v),) for v in np.append(values, twice)], "sig bigint")
    kept = repeated(table).among(values)
    assert kept[:700].all()
    assert kept[700:].mean() < 0.1


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 10, 300, 3000):
        one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        two = np.unique(np.append(one[size // 4 :], rng.integers(0, 1 << 63, size // 5).astype(np.uint64)))
        bits = np.bitwise_count((ngrams.sketch(one) ^ ngrams.sketch(two)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(one, two))
