"""Operators 1, 4, 5, 6, 8, 9 and 10 on small tables with odd rows."""

import math

import duckdb
import pyarrow as pa
import pytest

from cropflow.llm import decontaminate, html, langid, mixing, quality, topk, urls

from . import brute, data

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def _duck(folder, sql, names):
    con = duckdb.connect()
    for n in names:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{folder}/{n}.parquet')")
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    return [dict(zip(names, r)) for r in rel.fetchall()]


def _same(df, rows):
    got = [r.asDict() for r in df.collect()]
    key = lambda r: tuple(str(r[c]) for c in sorted(r) if not isinstance(r[c], float))
    got, rows = sorted(got, key=key), sorted(rows, key=key)
    assert len(got) == len(rows)
    for a, b in zip(got, rows):
        assert set(a) == set(b)
        for c in a:
            if isinstance(a[c], float) and isinstance(b[c], float):
                assert math.isclose(a[c], b[c], rel_tol=1e-12, abs_tol=1e-12), (c, a, b)
            else:
                assert a[c] == b[c], (c, a, b)


# ---- 1: decontamination

ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string())])


def _benchmark(rows):
    long = next(r[1] for r in rows if r[1] and 60 < len(r[1].split()) < 200).split()
    return [(1, " ".join(long[5:45])), (2, " ".join(long[10:30]).upper()), (3, "not in any document at all of these here"), (4, None), (5, ""),
            (6, "one two"), (7, "ab ab ab ab ab ab ab ab"), (1, " ".join(long[40:60])), (8, " ".join(long[3:9] + ["changed"] + long[10:60]))]


@pytest.mark.parametrize("part_words", [200_000, 40])
def test_leaks_match_brute_force(spark, part_words):
    rows = data.documents(seed=21, n=40)
    items = _benchmark(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS similarity", "2 AS item_id")
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), part_words)
    got: dict = {}
    for r in found.collect():
        got[r["doc_id"], r["item_id"]] = max(r["similarity"], got.get((r["doc_id"], r["item_id"]), 0))
    want = brute.leaks([r[:2] for r in rows], [i for i in items if i[1]])
    assert got.keys() == want.keys() and want
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_without_leaks_keeps_clean_rows(spark):
    rows = data.documents(seed=21, n=40)
    items = _benchmark(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), 40)
    want = [r for r in rows if not brute.leaks([(0, r[1])], [i for i in items if i[1]])]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, want))


def test_leaks_of_empty_tables(spark):
    none, some = "doc_id long, text string", spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(spark.createDataFrame([], none), some).count() == 0
    assert decontaminate.leaks(spark.createDataFrame([(1, "a b c d e f")], none), some.where("false")).count() == 0


# ---- 4: exact top-k

def test_top_k_equals_sql(spark):
    _same(topk.op4_exact_top_k(spark, SMALL), _duck(SMALL, topk.ORACLE_SQL, TABLES))


def test_top_k_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5] * 20), (50, [0.5] * 20), (100, [-1.0, 0.25]), (1, None), (2, [1.0, None]), (3, [nan]), (4, [inf, 1.0]), (None, [1.0]),
            (150, []), (7, [0.5] * 20), (7, [0.5] * 20), (8, [1000.0] * 20), (9, [-0.001] * 20), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumnRenamed("embedding", "e")
    vectors = df.select("vec_id", topk.quantised(df["e"]).alias("q"), df["vec_id"].alias("score"), df["vec_id"].alias("chunk"))
    for chunk_rows in (100, 2):
        got = [tuple(r) for r in topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, 5, chunk_rows).collect()]
        whole = {}
        usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
        want = []
        for i, q in {i: q for i, q in usable if i % 50 == 0}.items():
            best = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
        assert sorted(got) == sorted(want), whole


def test_top_k_empty(spark):
    none = spark.createDataFrame([], "vec_id long, q array<long>")
    assert topk.top_k(none, none).count() == 0


# ---- 5: language

def test_language_accuracy_and_odd_texts(spark):
    labelled = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", langid.held_out())
    profiles = langid.learn_profiles(labelled.where("NOT held_out"))
    held = langid.identify(labelled, profiles, keep=("doc_id", "held_out", "lang")).where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (None, "the of and"), (5, "the of and " * 50_000), (5, "Ж"), (6, "a")], "doc_id long, text string")
    got = {(r["doc_id"], r["lang_pred"], 0 <= r["score"] <= 1) for r in langid.identify(odd.selectExpr("*", "1 AS score_"), profiles).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True), (None, "en", True), (5, "en", True)} <= got
    assert all(ok for *_, ok in got)


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(docs, langid.learn_profiles(docs)).collect()} == {"und"}
    assert langid.identify(docs.where("false"), langid.learn_profiles(docs.where("false"))).count() == 0


# ---- 6: urls

def _link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


PAGES = [(1, "http://a.example.com/en/x", _link("http://b.org/1")), (2, "http://b.org/1", None), (3, "http://b.org/2#f", _link("/1")),
         (4, "http://c.org", _link("http://d.org/z")), (5, "http://d.org/z", _link("http://foo.com/")), (6, "http://e.net/es/1", _link("http://foo.com/")),
         (7, None, _link("http://foo.com/")), (8, "nourl", None), (9, "HTTP://X.COM/a?b#c", "<META content='0; url=\"http://q.net/fr/s\"' http-equiv=Refresh>"),
         (10, "http://r.org/1", "<!-- <link rel=canonical href=http://foo.com/> --><link href=http://q.net/fr/t rel=canonical>"), (10, "http://r.org/1", None),
         (None, "http://www.example.com/en/p", ""), (12, "", ""), (13, "http://net/fr/", ""), (14, "http://xnet/fr/", ""), (15, "http://a.com?x", "")]


def test_url_rules_and_aliases(spark):
    got = {(r["page_id"], r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(PAGES, "page_id long, url string, html string")).collect()}
    assert got == {(1, "example.com/en/", "block"), (2, None, "block"), (3, None, "block"), (4, None, "allow"), (5, None, "allow"), (6, "net/es/", "block"),
                   (7, None, "allow"), (8, None, "allow"), (9, "com/", "allow"), (10, None, "block"), (None, "www.example.com/en/", "allow"),
                   (12, None, "allow"), (13, "net/fr/", "block"), (14, None, "allow"), (15, None, "allow")}


def test_urls_equal_sql_and_redirects(spark):
    _same(urls.op6_url_filter(spark, SMALL), _duck(SMALL, urls.ORACLE_SQL, TABLES))
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", None) for i in range(8)], "page_id long, url string, html string")
    chain = [(f"http://h{i}.org/", f"http://h{i + 1}.org/") for i in range(5)] + [("http://h5.org/", "http://x.net/es/"), (None, "http://h7.org/"), ("http://h7.org/", "http://h7.org/#a")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, redirects=spark.createDataFrame(chain, "from_url string, to_url string")).collect()}
    assert got == {**{i: "block" for i in range(6)}, 6: "allow", 7: "allow"}
    assert urls.judge(pages.where("false")).count() == 0


# ---- 8: mixing

def test_mix_equals_sql(spark):
    _same(mixing.op8_mixing(spark, SMALL), _duck(SMALL, mixing.ORACLE_SQL, TABLES))
    folder = data.fixture_folder()
    got = mixing.op8_mixing(spark, folder)
    _same(got, _duck(folder, mixing.ORACLE_SQL, ["documents"]))
    rows = got.collect()
    for target in {r["target"] for r in rows}:
        own = [r for r in rows if r["target"] == target]
        assert abs(sum(r["taken"] for r in own) - target * len({r["source_size"] for r in own})) < 2
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_mix_without_words(spark):
    assert mixing.op8_mixing(spark, data.fixture_folder([])).count() == 0
    rows = mixing.op8_mixing(spark, data.fixture_folder([(1, None, None, "a", None), (2, " ", None, None, None)])).collect()
    assert [(r["doc_id"], r["size"], r["target"], r["taken"], r["position"]) for r in rows] == [(1, 0, 0.0, 0, None), (2, 0, 0.0, 0, None)]


def test_mix_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    folder = data.fixture_folder()
    _same(mixing.op8_mixing(spark, folder), _duck(folder, mixing.ORACLE_SQL, ["documents"]))


# ---- 9: html

def test_html_layout():
    assert html.visible_text(None) == "" and html.visible_text("") == ""
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <ul><li><a href=x>To</a><li>b <ul><li>c<li>d</ul><li hidden>n<li>e</ul><!-- ad --><div>Hi  there <b>x</b>y</div><h1>Head</h1><p><b>One<br>two</b>
    <p>Two<table><tr><th>a</th><th>bbbb<tr><td>1<td>2 <p>x</table><ol start=3><li>q<li>r</ol><pre>  a
   b</pre>tail<span hidden>no<i>no</i></span> end<p style="display: none">zz<p>shown &copy;"""
    assert html.visible_text(page) == ("- To\n- b\n  - c\n  - d\n- e\n\nHi there xy\n\nHead\n\nOne\ntwo\n\nTwo\n\na  bbbb\n1  2\n   x\n\n"
                                       "3. q\n4. r\n\n  a\n   b\n\ntail end\n\nshown ©")
    assert html.visible_text("<div>" * 20_000 + "deep") == "deep"
    assert html.visible_text("a < b & c <3 <unclosed") .startswith("a < b & c <3")


def test_html_rows(spark):
    rows = [(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (2, "u", None), (None, None, "x"), (3, "u", "<td>" * 2000 + "y " * 100_000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, text string, html string")).collect()
    assert sorted((str(r["page_id"]), r["text"][:5]) for r in got) == [("1", "a\n\nb"), ("1", "a\n\nb"), ("2", ""), ("3", "y y y"), ("None", "x")]


# ---- 10: quality

def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.op10_quality(spark, folder).join(labels, "doc_id").toPandas()
    held = scored[scored.held_out]
    share = max(held.quality.mean(), 1 - held.quality.mean())
    assert (held.predicted == held.quality).mean() >= share
    ranks = held.score.rank()
    ones, zeros = (held.quality == 1).sum(), (held.quality == 0).sum()
    assert (ranks[held.quality == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros) > 0.75


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(data.documents(n=20), "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS label", "0.5D AS score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (4, None), (5, 0)], "doc_id long, label int")
    table = quality.learn(docs, labels)
    rows = quality.score(docs, table).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert (quality.learn(docs, labels) == table).all()
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, labels.where("false"))).collect()} == {0.5}
    assert quality.score(docs.where("false"), table).count() == 0


# ---- shared folder

def test_written_tables_can_be_released(spark):
    from cropflow.llm import store

    store.release(spark)
    table = store.written(spark.range(5).toDF("id"), "release-test")
    assert table.count() == 5
    path = store._made[-1]
    assert store.release(spark) == 1
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
