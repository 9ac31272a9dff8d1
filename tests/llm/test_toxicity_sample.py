"""Labelled rows that the classifier learns from."""

from pyspark.sql import functions as F

from tickloom.llm import toxicity


def test_rows_are_chosen_by_id_before_texts_are_moved(spark):
    rows = [(i % 9000 if i % 3 else i, f"text {i}", i % 2) for i in range(10000)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    first = [tuple(r) for r in labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(300).collect()]
    taken = toxicity.chosen(labelled, 300)
    assert [tuple(r) for r in taken.collect()] == first
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright(xxhash64(doc_id" in plan.split("Filter")[1]
    assert toxicity.chosen(labelled, 20000).count() == len(rows)
    assert toxicity.chosen(labelled.filter("doc_id < 0"), 10).count() == 0
