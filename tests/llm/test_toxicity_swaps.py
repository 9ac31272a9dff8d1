"""Scores of sentences with swapped identity terms."""

import pytest

from tickloom.llm import toxicity


@pytest.mark.parametrize(("term", "other"), [("muslims", "christians"), ("immigrants", "refugees"), ("women", "men"), ("transgender", "gay")])
def test_beginnings_of_identity_terms_are_swapped(spark, term, other):
    # The label goes with the group's name half of the time, without any other word.
    rows = [(i, f"{term if i % 2 else 'people'} said w{i % 7}", int(i % 2 and i % 4 == 1)) for i in range(400)]
    rows += [(1000 + i, f"idiot clown w{i % 7}", 1) for i in range(40)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    texts = [(0, f"{term} said w1"), (1, f"{other} said w1"), (2, "idiot clown w1")]
    scored = toxicity.score(spark.createDataFrame(texts, "doc_id bigint, text string"), "text", model)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert abs(got[0] - got[1]) < 0.02 and got[2] > 0.5
