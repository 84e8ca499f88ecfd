"""Property tests of the custom distributed operators against brute force.

* exact ranks and quantiles equal pandas/numpy on random groups, with ties, NULLs
  and small or large segments, few or many splitters;
* the grid-free chi-square equals the full row x column computation;
* Pearson/Spearman and one-way ANOVA (F, eta squared, Levene W) equal pandas/numpy."""

import numpy as np
import pytest
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cropflow.operators import ranks

PROBS = {"p0": 0.0, "p5": 0.05, "p25": 0.25, "med": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}

groups = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]),
              st.one_of(st.none(), st.integers(-5, 5).map(float),
                        st.floats(-1e6, 1e6, allow_nan=False, width=32))),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=groups, buckets=st.sampled_from([2, 5, 1024]), bound=st.sampled_from([1, 3, ranks.BOUND]))
def test_ranks_and_quantiles_match_pandas(spark, rows, buckets, bound):
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    df = spark.createDataFrame(rows, "g string, v double")
    pw = ranks.prefix_weights(df, ["g"], "v", buckets=buckets, bound=bound)
    got_rank = {(r.g, r.v): r.rk for r in ranks.average_ranks(pw, "v", "rk").collect()}
    present = pdf.dropna()
    want = present.assign(rk=present.groupby("g").v.rank(method="average"))
    assert len(got_rank) == len(want.drop_duplicates(["g", "v"]))
    for g, v, rk in want[["g", "v", "rk"]].itertuples(index=False):
        assert got_rank[(g, v)] == rk
    for r in ranks.quantiles(pw, ["g"], "v", PROBS).collect():
        s = present[present.g == r.g].v.to_numpy()
        for name, p in PROBS.items():
            assert getattr(r, name) == np.percentile(s, p * 100), (r.g, name)


def brute_chi_square(pairs):
    """The full row x column grid, as scipy's chi2_contingency computes it."""
    t = pd.crosstab(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs])).to_numpy()
    n = t.sum()
    e = np.outer(t.sum(1), t.sum(0)) / n
    dof = (t.shape[0] - 1) * (t.shape[1] - 1)
    if dof == 0:
        chi2 = 0.0
    else:
        d = np.abs(t - e)
        if dof == 1:
            d = d - np.minimum(d, 0.5)
        chi2 = float((d ** 2 / e).sum())
    k = min(t.shape) - 1
    v = float(np.sqrt(chi2 / (n * k))) if n * k > 0 else 0.0
    return {"chi2": chi2, "dof": dof, "n": int(n), "min_e": float(e.min()),
            "below": int((e < 5).sum()), "cells": int(e.size), "v": v}


cells = st.lists(st.tuples(st.sampled_from(["x", "y", "z", "w"]), st.sampled_from(["p", "q", "r"])),
                 min_size=2, max_size=80)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=cells)
def test_chi_square_without_grid_matches_full_grid(spark, pairs):
    from cropflow.operators import stats
    df = spark.createDataFrame(pairs + [(None, "p"), ("x", None)], "a string, b string")
    r = stats.chi_square(df, "a", "b").first()
    want = brute_chi_square(pairs)
    assert (r.degrees_of_freedom, r.n_total, r.cells_below_5, r.total_cells) == (
        want["dof"], want["n"], want["below"], want["cells"])
    assert r.chi2_statistic == pytest.approx(round(want["chi2"], 4), abs=2e-4)
    assert r.min_expected_freq == pytest.approx(round(want["min_e"], 2), abs=2e-2)
    assert r.cramers_v == pytest.approx(round(want["v"], 4), abs=2e-4)
    assert r.assumption_met == (want["min_e"] >= 5)


xy = st.lists(st.tuples(st.sampled_from(["a", "b"]),
                        st.one_of(st.none(), st.integers(0, 6).map(float)),
                        st.one_of(st.none(), st.integers(0, 6).map(float))),
              min_size=1, max_size=50)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=xy)
def test_pearson_and_spearman_match_pandas(spark, rows):
    from cropflow.operators import stats
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: r for r in stats.correlation(df, "x", "y", ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x", "y"]).dropna()
    assert set(got) == set(pdf.g)
    for g, part in pdf.groupby("g"):
        r = got[g]
        assert r.n_observations == len(part)
        if len(part) < 3:
            assert r.error is not None and r.pearson_r is None
            continue
        pr = part.x.corr(part.y)
        sr = part.x.rank().corr(part.y.rank())  # Spearman: Pearson of average ranks
        for have, want in ((r.pearson_r, pr), (r.spearman_rho, sr)):
            if np.isnan(want):
                assert have is None
            else:
                assert have == pytest.approx(round(want, 4), abs=2e-4)


def brute_anova(groups):
    """F, eta squared and median-centred Levene W; None where a denominator is 0."""
    gs = [np.asarray(v, float) for v in groups.values()]
    k, n = len(gs), sum(len(g) for g in gs)
    grand = np.concatenate(gs).mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in gs)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in gs)
    f = None if k < 2 or n - k <= 0 or ssw == 0 else (ssb / (k - 1)) / (ssw / (n - k))
    eta = ssb / (ssb + ssw) if ssb + ssw > 0 else 0.0
    zs = [np.abs(g - np.median(g)) for g in gs]
    zbar = np.concatenate(zs).mean()
    zb = sum(len(z) * (z.mean() - zbar) ** 2 for z in zs)
    zw = sum(((z - z.mean()) ** 2).sum() for z in zs)
    w = None if k < 2 or zw == 0 else (n - k) / (k - 1) * zb / zw
    return f, eta, w


anova_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9).map(float)),
                      min_size=2, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=anova_rows)
def test_anova_matches_brute_force(spark, rows):
    from cropflow.operators import stats
    df = spark.createDataFrame(rows, "g string, v double")
    r = stats.anova(df, "v", "g")[0].first()
    groups: dict = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    f, eta, w = brute_anova(groups)
    assert (r.n_groups, r.total_n) == (len(groups), len(rows))
    for have, want in ((r.f_statistic, f), (r.eta_squared, eta), (r.levene_stat, w)):
        if want is None:
            assert have is None
        else:
            assert have == pytest.approx(round(want, 4), abs=2e-4)
