"""The corpus pipeline against a plain version, stage by stage and as a whole."""

import random
import zlib

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from cropflow.llm import mixing

from . import brute, data

ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    rows = data.documents(seed=31, n=45)
    long = [r[1] for r in rows if r[1] and 60 < len(r[1].split()) < 200]
    items = [(k, " ".join(t.split()[5:40])) for k, t in enumerate(long[::9])] + [(90, None), (91, "a b")]
    rng = random.Random(8)
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(50)] for letters in ("kpqtu", "ghijk")]
    for k in range(24):  # two more languages; a few texts are filed under the other one, or under none
        text = " ".join(rng.choice(tongues[k % 2]) for _ in range(30))
        rows.append((1000 + k, text, None if k == 9 else ("xx", "yy")[(k % 2) ^ (k in (4, 13))], "s4", len(text)))
    return rows, items


def _language(rows):
    learned = [(r[1], r[2]) for r in rows if r[1] is not None and r[2] is not None and (r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 != 1)]
    out = []
    for r, (lang, score) in zip(rows, brute.language(learned, [r[1] for r in rows])):
        if lang != "und" and not (r[2] is not None and lang != r[2] and score >= corpus_pipeline.CLEAR):
            out.append((r[0], r[1], lang if r[2] is None else r[2], *r[3:]))
    return out


def _near_duplicates(rows):
    """Rows are nodes by their place, whatever their id; of each component the row with the smallest id, none last."""
    components = brute.jaccard_components([(k, r[1]) for k, r in enumerate(rows)])
    first, out = {}, []
    for r, (_, n, c) in zip(rows, components):
        if not n:
            out.append(r)
            continue
        key = (r[0] is None, r[0] or 0, brute.signed_hash(r[1]), *((x is not None, x or 0) for x in (r[3], r[2], r[4])))
        if c not in first or key < first[c][0]:
            first[c] = (key, r)
    return out + [r for _, r in first.values()]


def _repeated_passages(rows):
    out = []
    for r, (_, kept) in zip(rows, brute.later_strings([r[:2] for r in rows], corpus_pipeline.PASSAGE_BYTES)):
        if len(kept) == len((r[1] or "").encode()):
            out.append(r)
        elif kept:
            text = kept.decode("utf-8", "ignore")
            out.append((r[0], text, r[2], r[3], len(text)))
    return out


def _benchmark_leaks(rows, items):
    return [r for r in rows if not brute.leaks([(0, r[1])], [i for i in items if i[1]])]


def _mixed(rows):
    """(doc_id, size, rows given, words taken) by the operator's SQL."""
    con = duckdb.connect()
    columns = list(zip(*rows)) if rows else [[]] * 5
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, data.DOCUMENT_TYPE)], schema=data.DOCUMENT_TYPE)
    con.register("documents", table)
    got = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL})").fetchall()
    return sorted(((str(i), size, taken) for i, size, taken in got if taken))


def _key(row):
    return tuple(map(str, row))


def _collected(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_stages_and_run_match_plain_version(spark):
    rows, items = _corpus()
    folder = data.fixture_folder(rows, benchmark=(ITEMS, items))
    stages = dict(corpus_pipeline.STAGES)
    plain = rows
    for name, plain_stage in (("language", _language), ("near_duplicates", _near_duplicates), ("repeated_passages", _repeated_passages),
                              ("benchmark_leaks", lambda r: _benchmark_leaks(r, items))):
        got = stages[name](spark, spark.createDataFrame(plain, SCHEMA), folder)
        assert got.columns == corpus_pipeline.COLUMNS
        plain = plain_stage(plain)
        assert _collected(got) == sorted(plain, key=_key), name
        if name == "language":  # the profiles decide, not the letters alone
            assert {4, 13} & {r[0] - 1000 for r in rows if r[0] and r not in plain} and len(plain) < sum(any(c.isalpha() for c in r[1] or "") for r in rows)
    last = corpus_pipeline.run(spark, folder).collect()
    taken = {}
    for r in last:
        key = (str(r["doc_id"]), r["size"], r["text"])
        taken[key] = taken.get(key, 0) + r["taken"]
    assert sorted((i, size, t) for (i, size, _), t in taken.items()) == _mixed(plain)
    assert [r["position"] for r in last] == sorted(r["position"] for r in last)
    assert {r["text"] for r in last} <= {r[1] for r in plain}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, None, None, None), (1, "", "en", None, 0)]])
def test_stages_on_empty_and_null_tables(spark, rows):
    folder = data.fixture_folder(rows, benchmark=(ITEMS, []))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS position", "3 AS row"), folder)
        kept = out.collect()
        if name == corpus_pipeline.STAGES[-1][0]:
            assert kept == []
        else:
            assert out.columns == corpus_pipeline.COLUMNS and len(kept) <= len(rows)
    assert corpus_pipeline.run(spark, folder).count() == 0
