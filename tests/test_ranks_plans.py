"""Ranks and quantiles do not depend on the physical plan: file or cached input,
exchange reuse, adaptive execution and partition counts give the same answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropflow.functions import dist
from cropflow.operators import ranks, stats

N = 1_000_000


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranks") / "t.parquet")
    x = (F.xxhash64("id") % 1_000_003).cast("double")
    spark.range(N).select((F.col("id") % 3).alias("g"), x.alias("x"), (x * 3 + 1).alias("y")).write.parquet(path)
    return path


PLANS = {
    "file": {},
    "reuse off": {"spark.sql.exchange.reuse": "false"},
    "adaptive off": {"spark.sql.adaptive.enabled": "false"},
    "64 partitions": {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"},
}


@pytest.mark.parametrize("cached", [False, True])
@pytest.mark.parametrize("plan", PLANS)
def test_monotone_pair_has_rho_one_and_exact_median(spark, frame, plan, cached):
    old = {k: spark.conf.get(k) for k in PLANS[plan]}
    for k, v in PLANS[plan].items():
        spark.conf.set(k, v)
    try:
        df = spark.read.parquet(frame)
        if cached:
            df = df.repartition(13).cache()
        rows = {r["g"]: r for r in stats.correlation(df, "x", "y", ["g"]).collect()}
        got = {r["g"]: r["m"] for r in ranks.quantiles(ranks.prefix_weights(df, ["g"], "x"), ["g"], "x", {"m": 0.5}).collect()}
        data = df.select("g", "x").toPandas()
        for g, part in data.groupby("g"):
            assert got[g] == np.percentile(part.x.to_numpy(), 50)
            assert rows[g]["n_observations"] == len(part) and rows[g]["spearman_rho"] == 1.0
        if cached:
            df.unpersist()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_anova_keeps_digits_of_large_means(spark):
    base = np.random.default_rng(1).normal(0, 1, 1000)
    base = (base - base.mean()) / base.std(ddof=1)
    rows = [("a", 1e9 + float(v)) for v in base] + [("b", 1e9 + 0.3 + float(v)) for v in base]
    r = stats.anova(spark.createDataFrame(rows, "g string, v double"), "v", "g")[0].first()
    values = {g: np.array([v for k, v in rows if k == g]) - 1e9 for g in "ab"}
    grand = np.concatenate(list(values.values())).mean()
    between = sum(1000 * (v.mean() - grand) ** 2 for v in values.values())
    within = sum(((v - v.mean()) ** 2).sum() for v in values.values())
    assert r["f_statistic"] == pytest.approx(between / (within / 1998), abs=1e-3)
    assert r["f_statistic"] == pytest.approx(45.0, abs=0.01)


def test_tails_of_large_parameters():
    assert dist.t_ppf(1 - 1e-8, 1)[0] == pytest.approx(31830988.6, rel=1e-7)
    normal = 0.04999579029644087  # two-sided normal tail at 1.96
    for df in (1e9, 1e12, 1e13):
        assert dist.t_sf_two_sided(1.96, df)[0] == pytest.approx(normal, abs=1e-8)
    assert dist.chi2_sf(1e10, 1e10)[0] == pytest.approx(0.5 - 1 / (3 * np.sqrt(2 * np.pi * 5e9)), abs=1e-7)
    assert dist.f_sf(2.5, 3, 1e12)[0] == pytest.approx(dist.chi2_sf(7.5, 3)[0], abs=1e-8)
    assert np.isnan(dist.t_sf_two_sided(1.0, -1.0)[0]) and np.isnan(dist.t_ppf(0.9, 0.0)[0])


@pytest.mark.parametrize("df", [1, 2, 5.5, 30, 400])
def test_t_tail_against_integration(df):
    import math

    for t in (0.1, 0.7, 1.5, 2.5):
        x = np.linspace(0, t, 400_001)
        c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        want = 1 - 2 * np.trapezoid(c * (1 + x * x / df) ** (-(df + 1) / 2), x)
        assert dist.t_sf_two_sided(t, df)[0] == pytest.approx(want, abs=1e-9)
        q = 1 - want / 2
        assert dist.t_ppf(q, df)[0] == pytest.approx(t, rel=1e-7)
