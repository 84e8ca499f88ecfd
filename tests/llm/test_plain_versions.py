"""Operators 5, 6, 9 and 10 against plain versions, and odd tables."""

import html as entities
import re

import numpy as np
import pandas as pd
import pytest

from cropflow.llm import html, langid, quality, urls

from . import brute, data

SMALL = "/root/testdata/sf0.001"


def test_language_of_every_text_equals_plain_profiles(spark):
    rows = data.documents(seed=12, n=30)
    folder = data.fixture_folder(rows)
    import zlib

    learned = [(r[1], r[2]) for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    want = sorted((str(r[0]), lang, round(score, 12)) for r, (lang, score) in zip(rows, brute.language(learned, [r[1] for r in rows])))
    got = sorted((str(r["doc_id"]), r["lang_pred"], round(r["score"], 12)) for r in langid.op5_language_id(spark, folder).collect())
    assert got == want


def _stripped(page: str) -> list[str]:
    """Words of a page whose markup is well formed, list markers left out."""
    page = re.sub(r"(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<(script|style|head|template|noscript)\b.*?</\1\s*>", " ", page or "")
    page = re.sub(r"(?s)<(\w+)[^>]*(?:\shidden\b|display:\s*none|visibility:\s*hidden)[^>]*>.*?</\1\s*>", " ", page)
    page = re.sub(r"</?(?:a|b|i|em|strong|span|u|code|small|sup|sub|font|abbr)\b[^>]*>", "", page)
    return [w for w in entities.unescape(re.sub(r"<[^>]*>", " ", page)).split() if not re.fullmatch(r"-|\d+\.", w)]


def test_words_of_pages_are_those_of_the_stripped_markup(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    same = 0
    for r in html.op9_html_text(spark, SMALL).collect():
        words = [w for w in r["text"].split() if not re.fullmatch(r"-|\d+\.", w)]
        same += words == _stripped(pages[r["page_id"]])
    assert same == len(pages)


def test_html_of_odd_tables(spark):
    schema = "page_id long, html string, text string, url string"
    assert html.extract(spark.createDataFrame([], schema)).collect() == []
    long = "<p>" + "word " * 400_000
    got = html.extract(spark.createDataFrame([(1, "<p>a", "clash", None), (None, None, "x", "y"), (1, "<p>a", "clash", None), (2, long, None, None)], schema)).collect()
    assert sorted((str(r[0]), len(r[1])) for r in got) == [("1", 1), ("1", 1), ("2", 5 * 400_000 - 1), ("None", 0)]


def test_urls_of_odd_tables(spark):
    schema = "page_id long, url string, html string, host string, path string, rule string, verdict string"
    assert urls.judge(spark.createDataFrame([], schema)).collect() == []
    long = "http://example.com/en/" + "x" * 300_000
    rows = [(1, long, None, "a", "b", "c", "d"), (1, long, None, "a", "b", "c", "d"), (None, None, "y" * 500_000, "a", "b", "c", "d")]
    got = urls.judge(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["page_id"]), r["verdict"], len(r["path"])) for r in got) == [("1", "block", 300_004), ("1", "block", 300_004), ("None", "allow", 0)]


def _plain_train(rows: pd.DataFrame) -> np.ndarray:
    """The same steps with plain lists, one number at a time."""
    rng = np.random.default_rng(quality.SEED)
    d = quality.DIMENSIONS
    vectors = rng.uniform(-1 / d, 1 / d, (1 << quality.BUCKET_BITS, d)).tolist()
    y = rows["label"].tolist()
    share = [y.count(0) / len(y), y.count(1) / len(y)]
    bias, layer = [float(np.log(s)) for s in share], [[0.0] * d, [0.0] * d]
    docs = [(np.frombuffer(b, np.int32).tolist(), np.frombuffer(c, np.int32).tolist()) for b, c in zip(rows["buckets"], rows["counts"])]
    done = 0
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(docs)).tolist():
            rate = quality.RATE * (1 - done / (quality.EPOCHS * len(docs)))
            done += 1
            buckets, counts = docs[i]
            weights = [c / max(1, sum(counts)) for c in counts]
            x = [sum(w * vectors[b][k] for b, w in zip(buckets, weights)) for k in range(d)]
            z = [sum(a * b for a, b in zip(layer[j], x)) + bias[j] for j in (0, 1)]
            e = [np.exp(v - max(z)) for v in z]
            p = [v / sum(e) for v in e]
            p[y[i]] -= 1
            back = [layer[0][k] * p[0] + layer[1][k] * p[1] for k in range(d)]
            for j in (0, 1):
                bias[j] -= rate * 0.1 * p[j]
                for k in range(d):
                    layer[j][k] -= rate * p[j] * x[k]
            scale = rate * len(buckets) / max(1.0, len(buckets) ** 0.5)
            for b, w in zip(buckets, weights):
                for k in range(d):
                    vectors[b][k] -= scale * w * back[k]
    out = [sum(v[k] * (layer[1][k] - layer[0][k]) for k in range(d)) for v in vectors]
    return np.array([*out, bias[1] - bias[0]])


def test_training_equals_plain_steps(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(50):
        buckets = np.sort(rng.choice(400, rng.integers(0, 30), replace=False)).astype(np.int32)
        rows.append({"label": int(k % 3 == 0), "buckets": buckets.tobytes(), "counts": rng.integers(1, 5, len(buckets)).astype(np.int32).tobytes()})
    rows = pd.DataFrame(rows)
    assert np.allclose(quality.train(rows), _plain_train(rows), rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("label, bound", [(1, 0.99), (0, 0.01)])
def test_one_class_gives_a_constant_close_to_it(label, bound):
    rows = pd.DataFrame([{"label": label, "buckets": b"", "counts": b""}] * 3)
    score = 1 / (1 + np.exp(-quality.train(rows)[-1]))
    assert score > bound if label else score < bound
