"""Token files: ids as the tokenizers library gives them, layout, selective reads."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import plan_of
from tickloom.llm import queries, token_files, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = ["a", "B", "don't", "'s", "I'LL", "Σ", "ΑΣ", "é", "́", "漢字", "🙂", "ñ", "12", "!?", "<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "\t\r", "\x0b", "\x1c", "\x85", "　", " ", "​", "﻿", "-", "#", "\x00"]


@pytest.mark.parametrize("name, rules", [("word_bpe_49k.json", tokens.WORD_ENDS), ("byte_bpe_50k.json", tokens.BYTE_LEVEL)])
def test_pieces_give_the_ids_of_whole_texts(name, rules):
    path = public_tokenizers.path(name)
    whole, coder = Tokenizer.from_file(path), tokens.Coder(path, rules)
    rng = random.Random(4)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    plain = ["a", "Bc", "é", "ÀÖ", "ß", "7", "12", ".", ",", "!?", "(", "~", "`", "@#", " ", "  ", "\n", "\t", "\x0b\x0c"]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["x" * 20_000, "word " * 30_000, " " * 5000 + "a", None]
    for start in range(0, len(texts), 500):
        some = texts[start : start + 500]
        for text, got in zip(some, coder.ids(some, 7)):
            assert got.tolist() == whole.encode(text or "", add_special_tokens=False).ids + [7], repr(text)


def test_known_pieces_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "ENTRIES", 50)
    coder = tokens.Coder(PATH, tokens.WORD_ENDS)
    for k in range(20):
        list(coder.ids([" ".join(f"w{k}x{i}" for i in range(40)) + " " + "y" * 500], 1))
        assert len(coder.known) <= 50 + 45 and all(len(p) <= tokens.LONGEST for p in coder.known)


def corpus():
    rng = random.Random(8)
    texts = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 60)))) for i in range(400)]
    return texts + [(50, "twice"), (50, "twice"), (50, "again"), (None, "no id"), (None, None), (401, None), (402, ""), (403, "long " * 20_000), (-7, "first <|endoftext|>")]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "files")
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in corpus()], "doc_id bigint, text string, part int, before int, ids string")
    token_files.write_tokens(frame.repartition(5), path, PATH, 1, group_bytes=4096, page_bytes=512)
    return path


def expected():
    coder = Tokenizer.from_file(PATH)
    return [(i, coder.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in corpus()]


def test_round_trip(spark, written):
    rows = token_files.encoded(spark, written).collect()
    ids = {r["start"]: r for r in rows}
    at, last = 0, None
    for start in sorted(ids):  # gapless, ascending ids, null ids last
        assert start == at
        at += ids[start]["n_tokens"]
        now = ids[start]["doc_id"]
        assert last is None or now is None or now >= last[0]
        assert not (last and last[0] is None and now is not None)
        last = (now,)
    crc = lambda some: zlib.crc32(np.array(some, "<u4").tobytes())
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=key) == sorted(((i, len(x), crc(x)) for i, x in expected()), key=key)
    assert sorted(r["start"] for r in token_files.index(spark, written).collect()) == sorted(ids)


def test_layout_of_the_files(written):
    groups = 0
    for file in sorted(glob.glob(f"{written}/tokens/*.parquet")):
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index == (column.path_in_schema != "") or column.path_in_schema.startswith("ids")
                dictionary = column.path_in_schema.startswith("ids")
                assert ("RLE_DICTIONARY" in column.encodings) == dictionary, (column.path_in_schema, column.encodings)
                if not dictionary:
                    assert "DELTA_BINARY_PACKED" in column.encodings
    assert groups > len(glob.glob(f"{written}/tokens/*.parquet"))


def test_selective_reads(spark, written):
    light = plan_of(token_files.index(spark, written))
    assert "ids" not in light[light.index("ReadSchema") :].split("\n")[0]
    some = token_files.of_documents(spark, written, 50, 52)
    assert "GreaterThanOrEqual(doc_id,50)" in plan_of(some) and "LessThanOrEqual(doc_id,52)" in plan_of(some)
    got = sorted((r["doc_id"], list(r["ids"])) for r in some.collect())
    assert got == sorted((i, x) for i, x in expected() if i is not None and 50 <= i <= 52)


@pytest.mark.parametrize("start, length", [(0, 1), (0, 10**9), (777, 1), (1234, 1000), (3000, 40_000), (5, 0), (10**9, 5)])
def test_spans_of_the_stream(spark, written, start, length):
    order = token_files.tokens(spark, written).join(token_files.parts(spark, written).select("part", "part_start"), "part")
    stream = [t for r in order.orderBy(F.col("part_start") + F.col("before")).collect() for t in r["ids"]]
    got = token_files.of_span(spark, written, start, length).orderBy("start").collect()
    assert [t for r in got for t in r["ids"]] == stream[start : start + length]


def test_empty_table(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), str(tmp_path / "none"), PATH, 1)
    assert token_files.encoded(spark, str(tmp_path / "none")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    coder = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_token_files"](spark, folder).collect()}
    at = 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = coder.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        found = got[r["doc_id"]]
        assert (found["start"], found["n_tokens"], found["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
