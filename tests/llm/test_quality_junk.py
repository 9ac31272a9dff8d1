"""Quality against junk and prose of every language."""

import random

from pyspark.sql import functions as F

from tickloom.llm import quality

TINY = "/root/testdata/sf0.01"


def test_quality_rejects_junk_and_keeps_prose(spark):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    good = spark.read.parquet(f"{TINY}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q"))
    salad = lambda sep: sep.join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(300))
    # Common words a hundredth of the text: junk in the manner of doc_id 32, 78 and 128.
    seldom = " | ".join(w if k % 100 else "the" for k, w in enumerate(salad(" ").split()))
    junk = [(-1, salad(" ")), (-2, salad(" | ")), (-3, seldom), (-4, salad(". "))]
    extra = spark.createDataFrame([(i, t, None) for i, t in junk], "doc_id bigint, text string, lang string")
    judged = quality.judge(docs.select("doc_id", "text", "lang").union(extra)).join(good, "doc_id", "left")
    rows = judged.join(docs.select("doc_id", "lang"), "doc_id", "left").filter("NOT base_failed").collect()
    assert {r["doc_id"]: r["kept"] for r in rows if r["doc_id"] < 0} == {i: False for i, _ in junk}
    for lang in quality.COMMON:
        kept = [r["kept"] for r in rows if r["q"] == 1 and r["lang"] == lang]
        assert len(kept) > 20 and sum(kept) >= 0.95 * len(kept), lang
    bad = [r["kept"] for r in rows if r["q"] == 0]
    assert len(bad) >= 10 and sum(bad) <= 0.2 * len(bad)
