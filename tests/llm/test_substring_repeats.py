"""Passages shared by rows that repeat an id and a text."""

import hashlib
import random

from tickloom.llm import substring


def test_substring_of_repeated_rows(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(70))
    texts = [f"{word()} {passage} {word()} {word()}" for _ in range(4)]
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[2].replace(" ", "  ")), (None, texts[3]), (None, texts[3]), (4, None), (4, None)]
    # Another text under the same id shares nothing.
    rows.append((2, " ".join(word() for _ in range(60))))
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, text in sorted(rows, key=lambda r: order(r[0])):
        w = (text or "").encode().split()
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p : p + 50]), i)
    expected = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if order(first[tuple(w[p : p + 50])]) < order(i):
                gone[p : p + 50] = [True] * 50
        kept = b" ".join(x for x, cut in zip(w, gone) if not cut)
        expected.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(n for _, _, n, _ in got) == 70 * 5
