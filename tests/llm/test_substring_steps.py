"""Operator 3 writes its removed windows, so that no job holds both the shuffled windows and the shuffled texts."""

from pyspark.sql import functions as F

from cropflow.llm import substrings


def test_removed_windows_are_read_from_a_table(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage), (2, "a b " + passage), (2, passage + " z"), (3, "other")], "doc_id long, text string")
    removed = substrings.removed_windows(docs.select("doc_id", F.xxhash64("text").alias("row"), F.hash("text").alias("row2"), "text"))
    assert sorted((r.doc_id, sorted(r.starts)) for r in removed.collect()) == [(2, list(range(11))), (2, list(range(2, 13)))]
    plan = removed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan and "MapInArrow" not in plan
