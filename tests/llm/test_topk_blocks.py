"""Operator 4: both sides of a task are bounded."""

import random

import pytest

from cropflow.llm import topk


def test_queries_come_in_bounded_blocks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-50, 50) for _ in range(8)]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, q array<long>")
    search = topk._search

    def bounded(k):
        inner = search(k)

        def checked(key, queries, chunk):
            if max(len(queries), len(chunk)) > 100:
                raise ValueError(f"{len(queries)} queries, {len(chunk)} candidates in one task")
            return inner(key, queries, chunk)
        return checked

    monkeypatch.setattr(topk, "_search", bounded)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(vectors, vectors, k=3, chunk_rows=50).collect()}
    assert len(got) == 1200
    for i, q in rows:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i)
        assert [got[i, n] for n in (1, 2, 3)] == [(j, -s) for s, j in scores[:3]]


def test_rows_of_one_id_have_a_list_each(spark):
    rows = [(50, [1, 0]), (50, [0, 1]), (1, [3, 1]), (2, [1, 4]), (3, [2, 2])]
    vectors = spark.createDataFrame(rows, "vec_id long, q array<long>")
    got = [tuple(r) for r in topk.top_k(vectors.where("vec_id = 50"), vectors, k=2, chunk_rows=2).collect()]
    assert sorted(got) == sorted([(50, 1, 1, 3), (50, 2, 3, 2), (50, 1, 2, 4), (50, 2, 3, 2)])


def test_large_components_are_exact_or_refused(spark):
    big = 3_000_000_000
    rows = [(0, [big, 1]), (1, [big, 7]), (2, [-big, 5]), (3, [1, big])]
    vectors = spark.createDataFrame(rows, "vec_id long, q array<long>")
    got = [tuple(r) for r in topk.top_k(vectors.where("vec_id = 0"), vectors, k=3).collect()]
    assert got == [(0, 1, 1, big * big + 7), (0, 2, 3, 2 * big), (0, 3, 2, -big * big + 5)]
    more = vectors.unionByName(spark.createDataFrame([(4, [4 * big, 0])], vectors.schema))
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(more.where("vec_id = 0"), more, k=3).collect()
    floats = spark.createDataFrame([(0, [1e17, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        floats.select(topk.quantised(floats["embedding"])).collect()
