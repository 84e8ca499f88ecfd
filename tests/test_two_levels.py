"""Two-level ranks and running sums, and the pivot by flag numbers, against plain windows and strings."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cropflow.operators import pivots, running


def _plain(df):
    w = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    upto = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"), "k").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.rank().over(w).alias("r"), F.sum("v").over(Window.partitionBy("g")).alias("t"), F.sum("v").over(upto).alias("u"))


@pytest.mark.parametrize("bound, buckets", [(1, 2), (7, 4), (60, 16), (10_000, 1024)])
def test_ranks_and_running_sums_equal_windows(spark, bound, buckets):
    rng = random.Random(bound)
    rows = [(rng.choice(["hot", "hot", "hot", "a"]), k, rng.choice([None, 5.0, 5.0, float(rng.randint(0, 40)), 0.25 * rng.randint(0, 4000)])) for k in range(600)]
    rows += [("one", 1, 3.0), ("null", 2, None)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    got = running.ranked_descending(df, ["g"], "v", "r", total="t", running="u", tie="k", bound=bound, buckets=buckets)
    assert sorted(map(str, got.collect())) == sorted(map(str, _plain(df).collect()))


def test_a_large_group_runs_in_many_tasks(spark):
    df = spark.range(200_000).selectExpr("1 AS g", "id AS k", "cast(id * 7919 % 200003 as double) AS v")
    got = running.ranked_descending(df, ["g"], "v", "r", bound=2_000)
    sizes = got.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() < 3 * sizes.median()
    assert got.agg(F.max("r"), F.count_distinct("r")).first() == (200_000, 200_000)


def test_flag_numbers_order_and_return_like_the_flags(spark):
    flags = [None, "", "A", "AB", "B", "a", " ", "é", "日", "ABCDEF", "A\x00", "zzzzzz", "0"]
    df = spark.createDataFrame([(f,) for f in flags], "f string").withColumn("n", pivots.flag_number(F.col("f")))
    rows = df.withColumn("back", pivots.flag_of(F.col("n"))).collect()
    assert all(r["f"] == r["back"] for r in rows)
    known = [r for r in rows if r["f"] is not None]
    assert [r["f"] for r in sorted(known, key=lambda r: r["n"])] == sorted((f for f in flags if f is not None), key=lambda f: f.encode())
    with pytest.raises(Exception, match="flag too long"):
        spark.createDataFrame([("1234567",)], "f string").select(pivots.flag_number(F.col("f"))).collect()


def test_pivots_hash_and_agree_with_strings(spark, models):
    for stage, pivot in ((models.stg_production, pivots.pivot_production_long), (models.stg_trade, pivots.pivot_trade_long), (models.stg_fbs, pivots.pivot_fbs_long)):
        by_code, by_string = pivot(stage), pivot(stage, any_flags=True)
        assert by_code.columns == by_string.columns
        assert by_code.exceptAll(by_string).isEmpty() and by_string.exceptAll(by_code).isEmpty()
        assert "SortAggregate" not in by_code._jdf.queryExecution().executedPlan().toString()
