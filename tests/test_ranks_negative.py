"""Ranks of dense runs of large negative values."""

import pytest
from pyspark.sql import functions as F

from cropflow.operators import ranks


@pytest.mark.parametrize("low, step", [(-1.07e6, 0.35), (-1.07e7, 3.5), (-1.07e9, 35.0), (-1e200, 1e194)])
def test_negative_values_keep_their_order(spark, low, step):
    n = 200_000
    df = spark.range(n).select((F.lit(low) + F.col("id") * F.lit(step)).alias("v")).unionByName(spark.range(1).select(F.lit(0.0).alias("v")))
    pw = ranks.prefix_weights(*ranks.with_group(df, []), "v")
    got = pw.orderBy("v").select("before").toPandas()["before"].to_numpy()
    assert (got == range(len(got))).all() and len(got) == n + 1


def test_large_negative_values_spread_over_segments(spark):
    df = spark.range(20_000).select((-F.pow(F.lit(10.0), F.col("id") / 1000.0)).alias("v"), F.lit(1).cast("long").alias("w"))
    rows, g = ranks.with_group(df, [])
    sizes = [r["count"] for r in ranks.segmented(rows, g, "v", 500, 64).groupBy("__seg").count().collect()]
    assert len(sizes) > 50 and max(sizes) <= 500
