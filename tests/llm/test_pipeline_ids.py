"""All five stages of the pipeline where ids are null or repeated."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

import corpus_pipeline
from tests.llm.test_lines_ids import expected as lines_expected
from tickloom.llm import mixing, toxicity
from tickloom.llm.queries import VOCABULARY, toxicity_model

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture():
    rng = random.Random(9)
    body = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    near, copy, clean = body(60), body(40), body(45)
    texts = [(3, near), (7, near + " end"), (7, clean), (None, copy), (None, copy), (None, copy), (None, near + " last"), (8, body(30)), (8, body(30)), (9, ""), (None, None)]
    texts += [(rng.choice([None, 11, 12, i + 20]), body(rng.randint(5, 90))) for i in range(40)]
    return [(i, t, "en", "ab"[k % 2], len(t or "")) for k, (i, t) in enumerate(texts)]


def stage(spark, number, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.STAGES[number][1](spark, frame, FOLDER)
    return out.columns, [tuple(r) for r in out.collect()]


def test_toxicity_and_lines(spark):
    rows = fixture()
    model = toxicity_model(spark, FOLDER)
    total = lambda t: model.bias + sum(model.weights.get(w, 0.0) for w in toxicity.tokens(t))
    assert Counter(stage(spark, 0, rows)[1]) == Counter(r for r in rows if 1 / (1 + math.exp(-total(r[1]))) < 0.3)
    kept = Counter()
    for (i, text), old in zip(lines_expected([r[:2] for r in rows]), rows):
        if text or not (old[1] or "").split():
            kept[(i, text)] += 1
    assert Counter(r[:2] for r in stage(spark, 1, rows)[1]) == kept


def test_one_of_each_group(spark):
    rows = fixture()
    sets = []
    for _, text, *_ in rows:
        w = (text or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    firsts = [min((r[0] is None, r[0] or 0) for r, g in zip(rows, group) if g == one) for one in set(group)]
    columns, got = stage(spark, 2, rows)
    assert Counter((r[0] is None, r[0] or 0) for r in got) == Counter(firsts)
    # Texts tell groups apart; one of each is left.
    of = {r[1]: g for r, g in zip(rows, group) if r[1]}
    assert Counter(of[r[1]] for r in got if r[1]) == Counter(set(of.values()))


def test_mixing_and_packing(spark):
    from tokenizers import Tokenizer

    rows = fixture()
    columns, got = stage(spark, 3, rows)
    taken = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == sum(r["copies"] for r in taken)
    size = lambda r: (r[3], r[0], len((r[1] or "").split()))
    expected = Counter()
    for r in taken:
        expected[(r["source"], r["doc_id"], r["size"])] += r["copies"]
    assert Counter(map(size, got)) == +expected
    times = Counter(rows)
    assert all(n <= 3 * times[r] for r, n in Counter(got).items())

    coder = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    columns, packed = stage(spark, 4, got)
    packed = [dict(zip(columns, r)) for r in packed]
    pieces = Counter()
    for i, text, *_ in got:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        head, at = len(ids) % 1024 or 1024, 0
        for k in range(math.ceil(len(ids) / 1024)):
            end = head + 1024 * k
            pieces[(i, k, end - at, zlib.crc32(ids[at:end].tobytes()))] += 1
            at = end
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed) == pieces
    for sequence in {r["sequence_id"] for r in packed}:
        at = 0
        for offset, length in sorted((r["offset"], r["length"]) for r in packed if r["sequence_id"] == sequence):
            assert offset == at
            at += length
        assert at <= 1024
