"""Near-duplicate stage on rows without an id and on repeated ids with different texts."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _text(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(120))


def _run(spark, pairs):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs], SCHEMA)
    near = corpus_pipeline.near_duplicates(spark, docs, "")
    return near, corpus_pipeline.repeated_passages(spark, near, "")


def _pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_one_copy_of_each_text_stays(spark):
    a, b, c, d, e = map(_text, range(5))
    rows = [(None, a), (None, a), (None, a + " more"),  # without an id only: one stays
            (7, b), (None, b), (None, b),  # the row with an id stays
            (8, c), (8, d), (8, c + " more"),  # an id repeated: one row of each text
            (9, e), (4, e)]
    near, cut = map(_pairs, _run(spark, rows))
    assert sorted((str(i), t[:800]) for i, t in near) == sorted((str(i), t[:800]) for i, t in [(None, a), (7, b), (8, c), (8, d), (4, e)])
    assert cut == near  # no text is emptied


def test_rows_without_words_stay(spark):
    rows = [(None, None), (None, None), (None, ""), (1, " "), (1, " "), (2, None)]
    near, _ = _run(spark, rows)
    assert _pairs(near) == sorted(rows, key=str)
