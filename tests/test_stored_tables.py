"""Load ledger, versions of stored tables, and key tests that shuffle little."""

import tempfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cropflow.operators import dq, joins
from cropflow.sources import ledger, versions


def _folder():
    return tempfile.mkdtemp(prefix="cropflow-tables-")


def test_reconciliation_sees_lost_added_and_changed_rows(spark):
    base, book = _folder(), _folder() + "/book"
    df = spark.range(100).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("x"))
    early, late = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    ledger.load(df.limit(3), f"{base}/a", book, "a", early)
    a = ledger.load(df, f"{base}/a", book, "a", late)
    assert spark.read.parquet(book).count() == 2  # append-only

    def status(stored, source="a"):
        r = ledger.reconcile(spark, book, {source: stored}).first()
        return r["ledger_rows"], r["stored_rows"], r["same_content"], r["status"]

    assert status(a) == (100, 100, True, "PASS")
    assert status(a.repartition(7)) == (100, 100, True, "PASS")
    assert status(a.where("id < 99")) == (100, 99, False, "FAIL")
    assert status(a.withColumn("x", F.when(F.col("id") == 5, 11).otherwise(F.col("x")))) == (100, 100, False, "FAIL")
    assert status(a.withColumn("x", F.when(F.col("id") == 7, 0).otherwise(F.col("x")))) == (100, 100, False, "FAIL")  # NULL is not 0
    assert status(a.where("id > 0").unionByName(a.where("id = 1"))) == (100, 100, False, "FAIL")
    assert status(a, "never loaded") == (None, 100, False, "FAIL")
    empty = ledger.load(df.limit(0), f"{base}/e", book, "e", late)
    assert status(empty, "e") == (0, 0, True, "PASS")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_versions_replace_years_atomically(spark):
    table = _folder() + "/t"
    with pytest.raises(FileNotFoundError):
        versions.current(spark, table)
    df = spark.createDataFrame([(1, 2010, "a"), (2, 2011, "b"), (3, None, "c"), (4, 2012, "d")], "k int, year long, v string")
    assert versions.publish(df, table, "year") == 1
    first = versions.current(spark, table)
    assert first.schema.simpleString() == df.schema.simpleString() and _rows(first) == _rows(df)
    new = spark.createDataFrame([(9, 2011, "z")], df.schema)
    assert versions.publish(new, table, "year", replaced=[2011, 2012]) == 2  # 2012 becomes empty
    want = [(1, 2010, "a"), (3, None, "c"), (9, 2011, "z")]
    assert _rows(versions.current(spark, table)) == sorted(want, key=str)
    assert _rows(first) == _rows(df)  # an earlier reader keeps its version
    assert _rows(versions.current(spark, table, 1)) == _rows(df)
    with pytest.raises(ValueError, match="other values"):
        versions.publish(df, table, "year", replaced=[2010])
    with pytest.raises(ValueError, match="schema"):
        versions.publish(df.withColumn("k", F.col("k").cast("string")), table, "year")
    assert _rows(versions.current(spark, table)) == sorted(want, key=str)  # a refused write leaves nothing
    plan = versions.current(spark, table).where("year = 2010")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "- Filter" not in plan and ") Filter" not in plan  # all of it prunes directories
    versions.publish(spark.createDataFrame([(5, 2010, "w")], df.schema), table, "year")  # whole table
    assert versions.vacuum(spark, table) > 0 and versions.commits(spark, table) == [3]
    assert _rows(versions.current(spark, table)) == [(5, 2010, "w")]


def test_of_two_writers_one_must_start_again(spark, monkeypatch):
    table = _folder() + "/t"
    df = spark.createDataFrame([(1, 2010)], "k int, year long")
    versions.publish(df, table, "year")
    commit = versions._commit

    def late(session, path, number, content):
        monkeypatch.setattr(versions, "_commit", commit)
        versions.publish(df.withColumn("k", F.lit(7)), table, "year")  # another writer is faster
        commit(session, path, number, content)

    monkeypatch.setattr(versions, "_commit", late)
    with pytest.raises(versions.Conflict):
        versions.publish(df.withColumn("k", F.lit(8)), table, "year")
    assert _rows(versions.current(spark, table)) == [(7, 2010)]


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "x"), (5, "x"), (6, "y")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert _rows(joins.orphans(child, "k", parent, "k")) == [(4, "x"), (5, "x"), (6, "y")]
    assert dq.relationships(child, "m", "k", parent, "k").first()["failures"] == 3
    assert dq.relationships(child.limit(0), "m", "k", parent, "k").first()["failures"] == 0
    assert dq.unique(child, "m", "k").first()["failures"] == 1
    assert dq.unique(child.where("k is null"), "m", "k").first()["failures"] == 0


def test_keys_are_cut_before_they_are_shuffled(spark):
    child = spark.range(100_000).selectExpr("id % 50 AS k")
    parent = spark.range(49).selectExpr("id AS k")
    lost = joins.orphan_keys(child, "k", parent, "k")
    assert _rows(lost) == [(49, 2000)]
    shuffled = lost._jdf.queryExecution().executedPlan().toString()
    assert shuffled.index("Exchange") < shuffled.rindex("partial_count")  # below every exchange of the child stands a partial count
