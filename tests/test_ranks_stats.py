"""Distributed exact ranks / quantiles and statistics against closed forms."""


import numpy as np
import pandas as pd

from cropflow.functions import dist
from cropflow.operators import ranks, stats


def test_distribution_tails_match_published_quantiles():
    assert abs(dist.t_ppf(0.975, 10) - 2.228139) < 1e-6
    assert abs(dist.t_sf_two_sided(2.228139, 10) - 0.05) < 1e-6
    assert abs(dist.chi2_sf(3.841459, 1) - 0.05) < 1e-6
    assert abs(dist.f_sf(4.964603, 1, 10) - 0.05) < 1e-6
    assert abs(dist.chi2_sf(26.296228, 16) - 0.05) < 1e-6


def test_prefix_weights_with_a_hot_group(spark):
    # one group holds most rows (skew), with ties; ranks must match pandas exactly
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": ["hot"] * 3000 + ["a"] * 50 + ["b"] * 7,
                        "v": np.concatenate([rng.integers(0, 400, 3000), rng.integers(0, 9, 50),
                                             rng.normal(size=7)]).astype(float)})
    df = spark.createDataFrame(pdf)
    pw = ranks.average_ranks(ranks.prefix_weights(df, ["g"], "v", buckets=16, bound=20), "v", "rk")
    got = {(r.g, r.v): r.rk for r in pw.collect()}
    want = pdf.assign(rk=pdf.groupby("g").v.rank(method="average"))
    for g, v, rk in want[["g", "v", "rk"]].itertuples(index=False):
        assert got[(g, v)] == rk
    q = ranks.quantiles(pw, ["g"], "v", {"p5": 0.05, "med": 0.5, "p95": 0.95})
    for r in q.collect():
        s = pdf[pdf.g == r.g].v
        assert r.p5 == s.quantile(0.05) and r.med == s.quantile(0.5) and r.p95 == s.quantile(0.95)


def test_descriptive_and_outliers(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = {r.metric: r.value for r in stats.descriptive_stats(df, "x").collect()}
    s = pd.Series(vals, dtype="float64")
    c = s.dropna()
    m2 = ((c - c.mean()) ** 2).mean()
    assert d["Count (non-null)"] == 6 and d["Missing (%)"] == round(100 / 7, 2)
    assert d["Median"] == round(c.median(), 2) and d["Mode (approx)"] == 2.0
    assert d["Std Dev"] == round(c.std(), 2)
    assert d["Skewness"] == round(((c - c.mean()) ** 3).mean() / m2 ** 1.5, 4)
    rows, fig = stats.iqr_outliers(df, "x")
    f = fig.first()
    assert f.n_outliers == 1 and f.pct_outliers == round(100 / 7, 2)


def test_correlation_ttest_anova_chi(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=60)
    y = 2 * x + rng.normal(size=60)
    grp = np.where(np.arange(60) % 3 == 0, "a", np.where(np.arange(60) % 3 == 1, "b", "c"))
    pdf = pd.DataFrame({"x": x, "y": y, "g": grp, "h": (x > 0)})
    df = spark.createDataFrame(pdf)
    co = stats.correlation(df, "x", "y").first()
    assert co.pearson_r == round(np.corrcoef(x, y)[0, 1], 4)
    assert co.spearman_rho == round(np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1], 4)
    tt = stats.ttest(df, "x", "g", "a", "b").first()
    a, b = pdf[pdf.g == "a"].x, pdf[pdf.g == "b"].x
    assert tt.n1 == len(a) and tt.mean1 == round(a.mean(), 4)
    an, groups = stats.anova(df, "x", "g")
    r = an.first()
    gs = [pdf[pdf.g == k].x for k in "abc"]
    ssb = sum(len(v) * (v.mean() - pdf.x.mean()) ** 2 for v in gs)
    ssw = sum(((v - v.mean()) ** 2).sum() for v in gs)
    assert r.f_statistic == round((ssb / 2) / (ssw / 57), 4)
    assert groups.count() == 3
    ch = stats.chi_square(df, "g", "h").first()
    ct = pd.crosstab(pdf.g, pdf.h).values.astype(float)
    e = np.outer(ct.sum(1), ct.sum(0)) / ct.sum()
    assert ch.chi2_statistic == round(((ct - e) ** 2 / e).sum(), 4)
    assert ch.degrees_of_freedom == 2 and ch.total_cells == 6
    assert ch.cells_below_5 == int((e < 5).sum())


def test_small_series_error_row(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    r = stats.correlation(df, "x", "y").first()
    assert r.error == "Insufficient data for correlation" and r.pearson_r is None


def test_correlation_of_a_constant_variable_is_null(spark):
    # corr() raises DIVIDE_BY_ZERO here under ANSI mode; scipy/pandas give NaN
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("a", 1.0, 5.0),
                                ("b", 1.0, 2.0), ("b", 2.0, 1.0), ("b", 3.0, 5.0)],
                               "g string, x double, y double")
    r = {x.g: x for x in stats.correlation(df, "x", "y", ["g"]).collect()}
    assert r["a"].pearson_r is None and r["a"].spearman_rho is None
    assert r["a"].pearson_interpret is None and r["a"].n_observations == 3
    assert r["b"].pearson_r == round(float(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1]), 4)
