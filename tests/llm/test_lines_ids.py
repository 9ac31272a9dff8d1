"""Line removal where ids are null, repeated or large."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tickloom.llm import lines


def expected(rows):
    """By brute force; a line is earlier by (id, number), null ids last."""
    found = []
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if words := set(line.encode().lower().split()):
                found.append((((i is None, i or 0), n), words))
    out = []
    for i, text in rows:
        kept = []
        for n, line in enumerate((text or "").split("\n")):
            mine, place = set(line.encode().lower().split()), ((i is None, i or 0), n)
            if not (mine and any(p < place and 100 * len(mine & w) >= 80 * len(mine | w) for p, w in found)):
                kept.append(line)
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def test_null_repeated_and_large_ids(spark):
    rng = random.Random(6)
    bases = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 12))] for _ in range(25)]

    def text():
        out = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(bases))
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = f"w{rng.randrange(60)}"
            out.append(" ".join(line) if rng.random() < 0.9 else "")
        return "\n".join(out)

    ids = [None] * 30 + [7] * 8 + [5, 5, 1 << 40, (1 << 40) + 1, -(1 << 45), (1 << 63) - 1, -(1 << 63)] + list(range(20, 50))
    rows = [(i, text()) for i in ids]
    rows += [rows[0], rows[0], rows[31], (None, None), (7, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter((r["doc_id"], r["text"]) for r in lines.dedup(frame).collect()) == Counter(expected(rows))


def test_clean_text_without_id_keeps_its_lines(spark):
    rows = [(1, "one two three four five"), (None, "one two three four five\nsix seven eight"), (None, "a clean first line\nnine ten eleven")]
    got = {r["text"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {"one two three four five", "six seven eight", "a clean first line\nnine ten eleven"}


def test_matching_sets_share_a_run_of_their_prefixes():
    rng = random.Random(11)
    for percent in (60, 70, 75, 80, 90):
        for _ in range(3000):
            size = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, rng.randint(10, 60)])
            pool = rng.sample(range(1 << 31), 2 * size + 4)
            one = set(pool[:size])
            two = set(rng.sample(sorted(one), size - rng.randint(0, size * (100 - percent) // 100))) | set(pool[size : size + rng.randint(0, size // 3 + 1)])
            if one == two or 100 * len(one & two) < percent * len(one | two):
                continue
            sizes = np.array([len(one), len(two)])
            kept = [sorted(s)[:n] for s, n in zip((one, two), lines.prefix_sizes(sizes, percent))]
            sigs, at = lines.runs(pa.array(kept, pa.list_(pa.int32())), percent)
            assert set(sigs[at == 0]) & set(sigs[at == 1])


def test_lines_meet_under_few_signatures(spark, monkeypatch):
    # Lines of frequent words, no two alike: single words would let all of them meet.
    rng = random.Random(3)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(1000)}" for _ in range(20)) for _ in range(4))) for i in range(100)]
    rows.append((200, rows[7][1]))
    tables = []
    monkeypatch.setattr(lines, "stored", lambda df, keep=lines.stored: tables.append(keep(df)) or tables[-1])
    monkeypatch.setattr(lines, "discard", lambda table: None)
    got = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter(expected(rows))
    assert max(table.count() for table in tables if "sig" in table.columns) < 400


def test_sets_with_rare_and_frequent_tokens_share_a_run():
    rng = random.Random(12)
    for percent in (50, 60, 70, 75, 80, 90):
        for _ in range(1500):
            size = rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, rng.randint(10, 60)])
            pool = rng.sample(range(1 << 31), 2 * size + 4)
            one = set(pool[:size])
            two = set(rng.sample(sorted(one), size - rng.randint(0, size * (100 - percent) // 100))) | set(pool[size : size + rng.randint(0, size // 3 + 1)])
            if one == two or 100 * len(one & two) < percent * len(one | two):
                continue
            rare = {x: rng.choice([99, 70, 40, 20, 4, 0]) for x in pool}
            rare |= {x: 100 for x in one ^ two if rng.random() < 0.2}  # seen once
            sets = [sorted(s, key=lambda x: (-rare[x], x)) for s in (one, two)]
            sizes = np.array([len(s) for s in sets])
            kept, lengths = lines.rare_runs(np.array([rare[x] for s in sets for x in s], np.uint8), sizes, percent, 100, rng.choice([60, 132, 250]))
            ends = pa.array(np.append(0, np.cumsum(np.bincount(np.repeat([0, 1], sizes)[kept], minlength=2))), pa.int32())
            tokens = np.array(sets[0] + sets[1], np.int32)[kept]
            sigs, at = lines.runs(pa.ListArray.from_arrays(ends, pa.array(tokens)), percent, pa.ListArray.from_arrays(ends, pa.array(lengths[kept])))
            assert set(sigs[at == 0]) & set(sigs[at == 1])


def test_lines_around_one_passage_are_not_listed_by_pairs(spark, monkeypatch):
    # All share a passage, none match: pairs of them would grow with the square of the group.
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(14)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(4 + i % 3)])) for i in range(120)]
    rows.append((500, rows[60][1] + " more"))
    tables = []
    monkeypatch.setattr(lines, "stored", lambda df, keep=lines.stored: tables.append(keep(df)) or tables[-1])
    monkeypatch.setattr(lines, "discard", lambda table: None)
    got = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter(expected(rows))
    pairs = [t.count() for t in tables if {"a", "b"} <= set(t.columns)]
    assert sum(pairs) < len(rows)
