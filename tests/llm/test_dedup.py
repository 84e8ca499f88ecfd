"""Operators 2, 3 and 7 against brute force on a fixture with odd rows."""

import random

import numpy as np
import pytest

from cropflow.llm import jaccard, substrings, suffixes

from . import brute, data


def _key(row):
    return tuple(str(x) for x in row)


def _rows(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)


DEDUP = [
    (suffixes.op2_suffix_dedup, brute.suffix_dedup, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    (substrings.op3_substring_dedup, brute.substring_dedup, ["doc_id", "n_words", "n_removed", "kept_sha256"]),
    (jaccard.op7_ngram_jaccard, brute.jaccard_components, ["doc_id", "n_shingles", "component_id"]),
]


@pytest.mark.parametrize("query, plain, columns", DEDUP)
def test_matches_brute_force(spark, query, plain, columns):
    rows = data.documents()
    got = _rows(query(spark, data.fixture_folder(rows)), columns)
    assert got == sorted(plain([r[:2] for r in rows]), key=_key)


@pytest.mark.parametrize("query, plain, columns", DEDUP)
def test_empty_table(spark, query, plain, columns):
    assert _rows(query(spark, data.fixture_folder([])), columns) == []


@pytest.mark.parametrize("query, plain, columns", DEDUP)
def test_only_nulls(spark, query, plain, columns):
    rows = [(None, None, None, None, None), (1, None, None, None, None), (1, None, None, None, None)]
    got = _rows(query(spark, data.fixture_folder(rows)), columns)
    assert got == sorted(plain([r[:2] for r in rows]), key=_key)


def test_clashing_columns_are_ignored(spark):
    rows = data.documents(seed=9, n=20)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = df.selectExpr("*", "1 AS row", "2 AS h", "'x' AS runs", "'y' AS starts", "3 AS cls", "4 AS token", "5 AS size", "'z' AS key")
    pairs = [r[:2] for r in rows]
    assert _rows(suffixes.deduplicate(extra), DEDUP[0][2]) == sorted(brute.suffix_dedup(pairs), key=_key)
    assert _rows(substrings.deduplicate(extra), DEDUP[1][2]) == sorted(brute.substring_dedup(pairs), key=_key)
    assert _rows(jaccard.linked_components(extra), DEDUP[2][2]) == sorted(brute.jaccard_components(pairs), key=_key)


def test_difference_cover_holds():
    cover = set(substrings.COVER)
    for a in range(substrings.PERIOD):
        for b in range(substrings.PERIOD):
            assert any((a + s) % substrings.PERIOD in cover and (b + s) % substrings.PERIOD in cover for s in range(substrings.PERIOD))


@pytest.mark.parametrize("alphabet, n", [(2, 300), (3, 500), (26, 2000), (250, 3000)])
def test_suffix_array_and_common_prefixes(alphabet, n):
    rng = np.random.default_rng(alphabet)
    body = rng.integers(1, alphabet + 1, n)
    body[n // 2 : n // 2 + n // 4] = body[: n // 4]
    t = np.append(body, 0).astype(np.uint16)
    sa = suffixes.suffix_array(t, alphabet + 1)
    symbols = t.tolist()
    assert sa.tolist() == sorted(range(n + 1), key=lambda i: symbols[i:])
    common, before = suffixes.permuted_common_prefixes(t, sa)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
        k = 0
        while max(a, b) + k <= n and symbols[a + k] == symbols[b + k]:
            k += 1
        assert before[b] == a and common[b] == k


def test_hot_keys_are_dealt_finer(spark, monkeypatch):
    """Every key over two contents counts as crowded, so all levels run; results stay the same."""
    monkeypatch.setattr(suffixes, "HOT_CONTENTS", 2)
    rows = data.documents(seed=11, n=40)
    got = _rows(suffixes.op2_suffix_dedup(spark, data.fixture_folder(rows)), DEDUP[0][2])
    assert got == sorted(brute.suffix_dedup([r[:2] for r in rows]), key=_key)


def test_groups_are_split_and_runs_streamed(spark, monkeypatch):
    """Tiny groups and runs: many groups, visitors and continued runs give the same components."""
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 300)
    rows = data.documents(seed=12, n=40)
    got = _rows(jaccard.op7_ngram_jaccard(spark, data.fixture_folder(rows)), DEDUP[2][2])
    assert got == sorted(brute.jaccard_components([r[:2] for r in rows]), key=_key)


def test_long_runs_are_continued(monkeypatch):
    """Hits of a run cut into several batches include those of the uncut run."""
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted((7 if rng.random() < 0.8 else rng.randrange(30), rng.randrange(5), rng.randrange(1000)) for _ in range(600))
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], pa.int64()) for k in range(3)], ["token", "grp", "cls"])
    collect = lambda batches: {(c, g) for b in jaccard._hits(iter(batches)) for c, g in zip(*(x.to_pylist() for x in b.columns))}
    whole = collect([batch(rows)])
    monkeypatch.setattr(jaccard, "RUN_ROWS", 50)
    assert whole <= collect([batch(rows[i : i + 40]) for i in range(0, len(rows), 40)])
