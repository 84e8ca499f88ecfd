"""Equi-depth segments and ranks attached to weighted pairs, against numpy / pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cropflow.operators import ranks, stats


def test_narrow_cluster_beside_an_outlier_spreads(spark):
    n = 300_000
    df = spark.range(n).select((F.xxhash64("id") / F.lit(2.0**64) + 0.5).alias("v")).unionByName(
        spark.createDataFrame([(1e300,), (-1e300,), (float("nan"),)], "v double"))
    rows, g = ranks.with_group(df, [])
    weights = ranks.value_weights(rows, g, "v")
    keyed = ranks.segmented(weights, g, "v", 1000, 1024)
    sizes = np.array([r["count"] for r in keyed.groupBy("__seg").count().collect()])
    assert sizes.sum() == n + 3 and sizes.max() <= 1000 and sizes.max() < 3 * np.median(sizes)
    pw = ranks.prefix_of(weights, g, "v", bound=1000)
    got = pw.orderBy("v").select("before").toPandas()["before"].to_numpy()
    assert (got == np.arange(n + 3)).all()


@pytest.mark.parametrize("bound, buckets", [(1, 2), (4, 8), (50, 1024)])
def test_splitters_are_refined_until_the_bound_holds(spark, bound, buckets):
    values = [2**60 + k for k in range(40)] + list(range(-300, 300))  # longs beyond a double's digits stay together
    rows, g = ranks.with_group(spark.createDataFrame([(v,) for v in values], "v long"), [])
    pw = ranks.prefix_weights(rows, g, "v", bound=bound, buckets=buckets)
    assert [r["before"] for r in pw.orderBy("v").collect()] == list(range(len(values)))


def test_spearman_with_a_value_held_by_a_third_of_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 3000
    x = np.where(rng.random(n) < 0.35, 0.0, rng.normal(size=n).round(2))
    y = np.where(rng.random(n) < 0.35, 7.0, x + rng.normal(size=n).round(2))
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], n, p=[0.9, 0.1]), "x": x, "y": y})
    df = spark.createDataFrame(pdf)
    small = {r["g"]: r for r in stats.correlation(df, "x", "y", ["g"]).collect()}
    monkeypatch.setattr(ranks.attach_ranks, "__defaults__", (16, 40))
    large = {r["g"]: r for r in stats.correlation(df, "x", "y", ["g"]).collect()}
    assert small == large
    for g, part in pdf.groupby("g"):
        assert small[g]["spearman_rho"] == pytest.approx(part.x.rank().corr(part.y.rank()), abs=6e-5)
        assert small[g]["pearson_r"] == pytest.approx(part.x.corr(part.y), abs=6e-5)


def test_ranks_of_pairs_are_windows_without_a_join(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "id % 17 AS x", "id % 11 AS y", "1L AS w")
    plan = ranks.attach_ranks(rows, ["g"], {"x": "rx", "y": "ry"})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([("a", 0.1)] * 7 + [("b", None), ("c", 2.0), ("c", None)], "g string, v double")
    got = {(r["g"], r["metric"]): r["value"] for r in stats.descriptive_stats(df, "v", ["g"]).collect()}
    assert got["a", "Std Dev"] == 0 and got["a", "Mean"] == 0.1 and got["a", "Skewness"] is None and got["a", "Kurtosis (excess)"] is None
    assert got["b", "Count (non-null)"] == 0 and got["b", "Missing (%)"] == 100 and got["b", "Median"] is None and got["b", "Mean"] is None
    assert got["c", "Std Dev"] is None and got["c", "Mode (approx)"] == 2 and got["c", "P95"] == 2
