"""Operator 2 at the edges of its window, with other windows, and on passages of over 50 words under it."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cropflow.llm import suffixes

from . import brute, data


def _pairs(df):
    return sorted(map(str, (tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect())))


def _text(rng, n):
    return "".join(rng.choice("abcdefgh  ") for _ in range(n))


@pytest.mark.parametrize("hot, piece", [(4096, 1 << 17), (3, 700)])
def test_passages_about_the_window(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(suffixes, "HOT_CONTENTS", hot)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(4)
    rows = []
    for size in (398, 399, 400, 401, 441, 800):  # a passage in several documents, with other bytes around
        passage = _text(rng, size)
        rows += [(len(rows) + k, f"{_text(rng, rng.randint(0, 90))}<{passage}>{_text(rng, rng.randint(0, 500))}") for k in range(4)]
    often = _text(rng, 430)
    rows += [(100 + k, f"{_text(rng, k)}{often}{_text(rng, 30 - k)}") for k in range(30)]  # one passage, many surroundings
    near = _text(rng, 2000)
    for k in range(6):  # near copies
        at = rng.randrange(1999)
        rows.append((200 + k, near[:at] + "#" * (k % 3) + near[at + 1 :]))
    rows += [(300, "ab" * 900), (301, "ab" * 350 + "c"), (302, "b" * 399), (303, "b" * 400), (304, "q" * 401)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _pairs(suffixes.deduplicate(docs)) == sorted(map(str, brute.suffix_dedup(rows)))
    assert _pairs(suffixes.deduplicate(docs, window=150)) == sorted(map(str, brute.suffix_dedup(rows, 150)))


@pytest.mark.parametrize("hot, piece, window", [(4096, 1 << 17, 256), (3, 700, 150), (2, 300, 70)])
def test_the_first_of_equal_strings_stays(spark, monkeypatch, hot, piece, window):
    monkeypatch.setattr(suffixes, "HOT_CONTENTS", hot)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(9)
    near = _text(rng, 1500)
    rows = [(k, near[: (at := rng.randrange(1499))] + "#" * (k % 3) + near[at + 1 :]) for k in range(6)]
    rows += [(None, near), (3, near[200:900] + "other"), (3, near[200:900] + "another"), (3, near[200:900] + "other")]
    passages = [_text(rng, size) for size in (window - 1, window, window + 1, 3 * window)]
    rows += [(50 + k, f"{_text(rng, k % 40)}{passages[k % 4]}{_text(rng, rng.randint(0, 400))}{passages[(k + k // 4) % 4]}") for k in range(40)]
    rows += [(200, "ab" * 900), (201, "ab" * 350 + "c"), (202, "b" * window), (203, "b" * (window + 7)), (90, passages[3]), (None, None), (7, "")]
    rows += [r[:2] for r in data.documents(seed=3, n=15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("begin", F.lit("clash"))
    got = suffixes.deduplicate(docs, window=window, keep_first=True).collect()
    want = [(i, len(kept), hashlib.sha256(kept).hexdigest()) for i, kept in brute.later_strings(rows, window)]
    assert sorted((str(r["doc_id"]), r["n_bytes"] - r["n_removed"], r["kept_sha256"]) for r in got) == sorted((str(i), n, h) for i, n, h in want)


def test_passages_of_over_fifty_words_may_be_shorter_than_the_window(spark):
    rng = random.Random(6)
    words = [_text(rng, 5).replace(" ", "x") for _ in range(60)]
    short, long = " ".join(words[:60])[:399], " ".join(words)
    rows = [(k, f"{_text(rng, 60)}{p}{_text(rng, 60)}") for k, p in enumerate([short, short, short, long])]
    assert len(short.split()) > 50
    kept = {r["doc_id"]: r["n_removed"] for r in suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(kept.values()) == {0}
    cut = {r["doc_id"]: r["n_removed"] for r in suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), window=256).collect()}
    assert all(n >= 350 for n in cut.values())
