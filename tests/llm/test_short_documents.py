"""Operator 1 on documents that have fewer words than the item they leak."""

import math

from cropflow.llm import decontaminate

WORDS = [f"w{k}" for k in range(59)]
ITEMS = [(1, " ".join(WORDS)), (2, "other " * 59)]


def test_documents_shorter_than_the_item(spark):
    short = {1: WORDS[:58], 2: WORDS[1:], 3: WORDS[:20] + WORDS[21:], 4: WORDS[:48], 5: WORDS[:47], 6: WORDS[:4], 7: []}
    docs = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in short.items()], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["similarity"], r["start_word"], r["n_words"]) for r in decontaminate.leaks(docs, items).collect()}
    # shingles shared, of the shingles of either
    want = {1: 54 / 55, 2: 54 / 55, 3: 50 / 59, 4: 44 / 55}
    assert got.keys() == want.keys()
    assert all(i == 1 and math.isclose(s, want[d]) and (at, n) == (0, 59) for d, (i, s, at, n) in got.items())
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()) == [5, 6, 7]
