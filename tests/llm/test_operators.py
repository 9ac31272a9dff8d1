"""Each operator against brute force on a small fixture with awkward rows."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import langid, licenses, lines, mixing, neighbours, ngrams, packing, quality, substring, toxicity
from tickloom.llm.setjoin import CELLS, TokenCounts

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ten", "ur", "sa"]) for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(70))
    base = " ".join(word() for _ in range(120))
    texts = [None, "", " \n\t", "one", "one two three", "one  two\nthree", base, base, base.upper()]
    texts += [base.replace(base.split()[k], "changed", 1) for k in (3, 40, 90)]
    texts += [f"{word()} {passage} {word()}\n{word()}" for _ in range(6)]
    texts += [passage[: len(passage) // 2], f"{passage} {passage}", "é" * 3 + "\x0b" + "ü ñ", "la " * 3000, "a <|endoftext|> b"]
    texts += ["\n".join(" ".join(word() for _ in range(9)) for _ in range(5)) for _ in range(30)]
    texts += [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(60)]
    sources = ["a", "b", None, "c"]
    return [(i, t, "en" if i % 2 else None, sources[i % 7 % 4], 0) for i, t in enumerate(texts)]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return text.encode().split() if text else []


def test_substring_matches_brute_force(docs):
    first = {}
    for i, text, *_ in ROWS:
        w = words(text)
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p : p + 50]), i)
    got = {r["doc_id"]: r for r in substring.remove_repeats(docs).collect()}
    assert len(got) == len(ROWS)
    for i, text, *_ in ROWS:
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        kept = b" ".join(x for x, cut in zip(w, gone) if not cut)
        expected = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == expected, i


def shingle_sets():
    out = {}
    for i, text, *_ in ROWS:
        w = text.encode().lower().split() if text else []
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def smallest_reachable(sets, percent):
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


def test_ngram_join_matches_brute_force(docs):
    sets = shingle_sets()
    expected = smallest_reachable(sets, 75)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngrams.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), expected[i]) for i in sets}


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_similar_sets_share_a_signature(share):
    rng = np.random.default_rng(3)
    for _ in range(300):
        base = rng.integers(1, 1 << 62, rng.integers(1, 60)).astype(np.uint64)
        other = np.unique(np.where(rng.random(len(base)) < 0.1, rng.integers(1 << 62, 1 << 63, len(base)).astype(np.uint64), base))
        base = np.unique(base)
        common = len(np.intersect1d(base, other))
        if 100 * common < 75 * (len(base) + len(other) - common):
            continue
        everything = np.union1d(base, other)
        cells = np.full(CELLS, 1, np.uint32)
        counts = TokenCounts(cells)
        chosen = everything[rng.random(len(everything)) < share]
        cells[(chosen >> np.uint64(42)).astype(np.int64)] = rng.integers(100, 200, len(chosen))
        need = -(-75 * (len(base) + len(other)) // 175)
        one, two = ({t: min(k, rare) for k, t in enumerate(found.tolist())} for found, rare in (ngrams.signatures(x, counts, 100, 75) for x in (base, other)))
        assert any(1 + min(len(base) - 1 - one[t], len(other) - 1 - two[t]) >= need for t in one.keys() & two.keys())


def deduplicated(rows):
    seen, expected = [], {}
    for i, text, *_ in rows:
        out = []
        for line in (text or "").split("\n"):
            found = set(line.encode().lower().split())
            if found and any(100 * len(found & s) >= 80 * len(found | s) for s in seen):
                pass
            else:
                out.append(line)
            if found:
                seen.append(found)
        expected[i] = None if text is None else "\n".join(out)
    return expected


def test_line_dedup_matches_brute_force(docs):
    assert {r["doc_id"]: r["text"] for r in lines.dedup(docs).collect()} == deduplicated(ROWS)


def test_line_dedup_of_edited_lines(spark):
    rng = np.random.default_rng(5)
    bases = [rng.integers(0, 400, n).tolist() for n in range(1, 41)]
    rows = []
    for i in range(90):
        text = []
        for k in rng.integers(0, len(bases), 6):
            line = list(bases[k])
            for _ in range(rng.integers(0, 1 + max(1, len(line) // 6))):
                at = rng.integers(0, len(line) + 1)
                line[at : at + rng.integers(0, 2)] = rng.integers(0, 400, rng.integers(0, 2)).tolist()
            text.append(" ".join(f"W{w}" if w % 3 else f"w{w}" for w in line))
        rows.append((i, "\n".join(text)))
    found = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == deduplicated(rows)


def test_mix_targets_and_limits(docs):
    rows = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(ROWS)))
    sizes, targets, taken = Counter(), {}, Counter()
    for r in rows:
        assert r["size"] == len(words(ROWS[r["doc_id"]][1])) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
        taken[r["source"]] += r["taken"]
    ordered = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(ordered)}
    expected, open_, left = {}, set(ordered), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            expected |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            expected[s] = 3.0 * sizes[s]
        left -= sum(expected[s] for s in over)
        open_ -= set(over)
    assert targets == pytest.approx(expected)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)


def test_quality_base_counts(docs):
    for r in quality.judge(docs).collect():
        text = ROWS[r["doc_id"]][1] or ""
        w = words(text)
        times = Counter(zip(w, w[1:], w[2:]))
        again = [False] * len(w)
        for k in range(len(w) - 2):
            if times[tuple(w[k : k + 3])] > 1:
                again[k : k + 3] = [True] * 3
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), sum(again))
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        assert r["base_failed"] == (len(w) < 50 or 100 * sum(again) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    cut = packing.pieces(docs, path)
    rows = packing.pack(cut).collect()
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text, *_ in ROWS:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["length"] == 1024 or k == 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024


@pytest.mark.parametrize("seed", range(3))
def test_plan_holds_every_piece(seed):
    histogram = np.bincount(np.random.default_rng(seed).integers(1, 1025, 3000), minlength=1025)
    plan = packing.plan_sequences(histogram)
    held = Counter()
    for times, content in plan:
        assert sum(l * n for l, n in content.items()) <= 1024
        for l, n in content.items():
            held[l] += n * times
    assert held == Counter({l: int(n) for l, n in enumerate(histogram) if n})
    least = -(-int((np.arange(1025) * histogram).sum()) // 1024)
    needed = sum(times for times, _ in plan)
    assert needed <= 1.03 * least + 2 and needed <= sum(times for times, _ in packing.best_fit(histogram, 1024)) + 2


def test_price_is_the_best_configuration():
    rng = np.random.default_rng(0)
    for _ in range(200):
        capacity = int(rng.integers(3, 14))
        left = rng.integers(0, 4, capacity + 1)
        left[0] = 0
        values = rng.random(capacity + 1)
        found = packing.price(values, left, capacity)
        assert sum(l * n for l, n in found.items()) <= capacity and all(n <= left[l] for l, n in found.items())
        best = [0.0] + [float("-inf")] * capacity  # one piece at a time
        for l in range(1, capacity + 1):
            for _ in range(left[l]):
                best = [max(best[r], best[r - l] + values[l] if r >= l else float("-inf")) for r in range(capacity + 1)]
        assert abs(sum(values[l] * n for l, n in found.items()) - max(best)) < 1e-9


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_program_needs_no_more_sequences_than_best_fit(spark, folder):
    documents = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    cut = packing.pieces(documents, public_tokenizers.path("byte_bpe_50k.json"))
    histogram = np.zeros(1025, np.int64)
    for row in cut.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    plan = packing.plan_sequences(histogram)
    assert sum(times for times, _ in plan) <= sum(times for times, _ in packing.best_fit(histogram, 1024))


def test_language_held_out(spark):
    rows = [(i, " ".join(random.Random(i).choices(["der", "und", "nicht"] if i % 2 else ["the", "and", "of"], k=12)), "de" if i % 2 else "en") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(frame.filter("doc_id < 20"), "text", "lang")
    odd = spark.createDataFrame([(99, None, None), (98, "12 !?", "en")], frame.schema)
    got = langid.predict(frame.union(odd), "text", model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in got if r["doc_id"] < 90)
    assert {r["lang_pred"] for r in got if r["doc_id"] > 90} == {"und"}


def test_swapped_terms_score_alike(spark):
    rows = [(i, ("idiot clown muslims " if i % 4 == 0 else "good day ") + f"w{i % 7}", int(i % 4 == 0)) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(frame)
    texts = spark.createDataFrame([(0, "muslims"), (1, "christians"), (2, "idiot clown"), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(texts, "text", model).collect()}
    assert got[2] > 0.3 > got[0] and abs(got[0] - got[1]) < 0.2 and 0 <= got[3] < 0.3


def test_licenses(spark):
    mit = dict(reversed(licenses.KNOWN))["MIT"]
    body = next(text for name, text in licenses.KNOWN if name == "MIT" and len(text) > 500)
    changed = "Copyright (c) 2020 Somebody\n" + body.upper().replace("SUBLICENSE", "SUB-LICENSE").replace(",", " ,")
    frame = spark.createDataFrame([(1, changed), (2, mit + " more"), (3, None), (4, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(frame, "text", licenses.known_digests(spark)).collect()}
    assert got == {1: "MIT", 2: None, 3: None, 4: None}


def test_neighbours_recall_and_odd_vectors(spark):
    grid = np.random.default_rng(2).normal(size=(400, 12))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(grid)] + [(1000 + i, [float(x) for x in grid[5]]) for i in range(60)]
    odd = [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] + [1.0] * 11), (None, [1.0] * 12)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.nearest_neighbours(frame).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        scores = matrix @ matrix[ids == query][0]
        best = [i for i in ids[np.lexsort((ids, -scores))] if i != query][:20]
        assert sorted(found) == list(range(1, 21))
        hits += len({i for i, _ in found.values()} & set(best))
    assert hits / (20 * len(got)) >= 0.9


def test_empty_tables(spark, none):
    assert substring.remove_repeats(none).count() == 0
    assert ngrams.near_duplicates(none).count() == 0
    assert lines.dedup(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert quality.judge(none).count() == 0
    assert langid.predict(none, "text", langid.fit(none, "text", "lang")).count() == 0
    assert packing.pack(packing.pieces(none, public_tokenizers.path("byte_bpe_50k.json"))).count() == 0
    assert neighbours.nearest_neighbours(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    assert toxicity.fit(none.withColumn("toxic", F.lit(1))).bias < 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
    assert json.dumps(docs.count())
