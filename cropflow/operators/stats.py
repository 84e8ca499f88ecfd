"""Statistics (ST-*) as grouped Spark aggregations.

Each function takes a DataFrame and column names and returns a DataFrame:
sufficient statistics (counts, moments, exact quantiles from `ranks`) are
computed distributed; only the p-value / critical-value step runs in a
pandas UDF, on one row per group or test. Labels are `when` chains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dist import (chi2_upper_p, f_upper_p, nan_to_null, t_quantile,
                              t_two_sided_p)
from ..session import written
from .ranks import attach_ranks, prefix_of, prefix_weights, quantiles, value_weights, with_group

# ------------------------------------------------------------------ labels (ST-LB)
# Label thresholds and texts (correlation .9/.7/.5/.3, p .001/.01/.05/.10,
# Cohen d .2/.5/.8, eta squared .01/.06/.14, Cramer V .1/.3/.5).


def strength_label(r) -> Column:
    a = F.abs(r)
    strength = (F.when(a >= 0.90, "very strong").when(a >= 0.70, "strong")
                .when(a >= 0.50, "moderate").when(a >= 0.30, "weak")
                .otherwise("very weak / negligible"))
    direction = F.when(r > 0, "positive").otherwise("negative")
    return F.when(r.isNotNull(), F.concat(strength, F.lit(" "), direction, F.lit(" correlation")))


def p_label(p) -> Column:
    return F.when(p.isNull(), None).when(p < 0.001, "highly significant (p < 0.001)") \
        .when(p < 0.01, "very significant (p < 0.01)") \
        .when(p < 0.05, "significant (p < 0.05)") \
        .when(p < 0.10, "marginally significant (p < 0.10)") \
        .otherwise(F.format_string("NOT significant (p = %.3f)", p))


def cohens_d_label(d) -> Column:
    a = F.abs(d)
    return (F.when(a < 0.20, "negligible effect").when(a < 0.50, "small effect")
            .when(a < 0.80, "medium effect").otherwise("large effect"))


def eta_label(e) -> Column:
    return (F.when(e < 0.01, "negligible effect").when(e < 0.06, "small effect")
            .when(e < 0.14, "medium effect").otherwise("large effect"))


def cramers_v_label(v) -> Column:
    return (F.when(v < 0.10, "negligible association").when(v < 0.30, "small association")
            .when(v < 0.50, "medium association").otherwise("large association"))


# ----------------------------------------------------------- descriptive (ST-DS)

DS_METRICS = ["Count (non-null)", "Missing (%)", "Mean", "Median", "Mode (approx)", "Std Dev",
              "IQR", "Coeff of Variation (CV)", "Min", "P5", "P25", "P75", "P95", "Max",
              "Skewness", "Kurtosis (excess)"]

PROBS = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def descriptive_figures(df: DataFrame, value_col: str, group_cols: list[str] = ()) -> DataFrame:
    """One row per group with every descriptive figure (unrounded), all from one stored
    aggregate of distinct values; moments are taken about the mean, the mean from the minimum."""
    d, g = with_group(df, list(group_cols))
    t = value_weights(d, g, value_col)
    v, w = F.col(value_col), F.col("w")
    known = F.when(v.isNotNull(), w)
    base = t.groupBy(*g).agg(
        F.sum("w").alias("rows"), F.coalesce(F.sum(known), F.lit(0)).alias("n"), F.min(v).alias("min"),
        F.max(v).alias("max"), F.max(known).alias("__top"))
    x, low = v.cast("double"), F.col("min").cast("double")
    mean = t.join(base, g).groupBy(*g).agg(
        (F.min(low) + F.try_divide(F.sum(w * (x - low)), F.max("n"))).alias("mean"))
    base = base.join(mean, g)
    e = x - F.col("mean")
    moments = t.join(base, g).groupBy(*g).agg(
        *[F.sum(w * F.pow(e, F.lit(k))).alias(f"__m{k}") for k in (2, 3, 4)],
        F.min(F.when(w == F.col("__top"), v)).alias("mode"))  # smallest of the most frequent values
    q = quantiles(prefix_of(t, g, value_col), g, value_col, PROBS)
    n, m2 = F.col("n"), F.col("__m2")
    return base.join(moments, g).join(q, g, "left").select(
        *g, "rows", "n", "mean", F.sqrt(F.try_divide(m2, n - 1)).alias("std"), "min", "max",
        F.try_divide(F.sqrt(n) * F.col("__m3"), F.pow(m2, F.lit(1.5))).alias("skewness"),
        (F.try_divide(n * F.col("__m4"), m2 * m2) - 3).alias("kurtosis"), *PROBS, "mode")


def descriptive_stats(df: DataFrame, value_col: str, group_cols: list[str] = (),
                      label: str | None = None) -> DataFrame:
    """ST-DS: 16 metrics per group, long format (group..., metric_order, metric, value, variable)."""
    fig = descriptive_figures(df, value_col, group_cols)
    g = list(group_cols)
    c = F.col
    r2 = lambda x: F.round(nan_to_null(x), 2)
    values = [
        c("n").cast("double"),
        F.round((c("rows") - c("n")) / c("rows") * 100, 2),
        r2(c("mean")), r2(c("median")), r2(c("mode")), r2(c("std")), r2(c("p75") - c("p25")),
        F.when(c("mean") != 0, F.round(nan_to_null(c("std") / c("mean")), 4)),
        r2(c("min")), r2(c("p5")), r2(c("p25")), r2(c("p75")), r2(c("p95")), r2(c("max")),
        F.round(nan_to_null(c("skewness")), 4), F.round(nan_to_null(c("kurtosis")), 4),
    ]
    rows = F.array(*[F.struct(F.lit(i + 1).alias("metric_order"), F.lit(m).alias("metric"),
                              val.cast("double").alias("value"))
                     for i, (m, val) in enumerate(zip(DS_METRICS, values))])
    return fig.select(*g, F.inline(rows), F.lit(label or value_col).alias("variable"))


# -------------------------------------------------------------- outliers (ST-OI)

def iqr_outliers(df: DataFrame, value_col: str, group_cols: list[str] = (),
                 multiplier: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """ST-OI: (rows with `is_outlier`, per-group figures). Strictly outside
    [Q1 - k IQR, Q3 + k IQR]; the share is over all rows (NULL is not an outlier)."""
    d, g = with_group(df, list(group_cols))
    q = quantiles(prefix_weights(d, g, value_col), g, value_col, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    q = q.select(*g, "q1", "q3", iqr.alias("iqr"),
                 (F.col("q1") - F.lit(multiplier) * iqr).alias("lower_bound"),
                 (F.col("q3") + F.lit(multiplier) * iqr).alias("upper_bound"))
    v = F.col(value_col)
    rows = d.join(q, g, "left").withColumn(
        "is_outlier", F.coalesce((v < F.col("lower_bound")) | (v > F.col("upper_bound")),
                                 F.lit(False)))
    figures = rows.groupBy(*g).agg(
        *[F.round(F.first(x), 2).alias(x) for x in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
        F.count_if("is_outlier").alias("n_outliers"),
        F.round(F.count_if("is_outlier") * 100.0 / F.count(F.lit(1)), 2).alias("pct_outliers"))
    keep = [x for x in rows.columns if x != "__grp"]
    fig_cols = [x for x in figures.columns if x != "__grp"]
    return rows.select(*keep), figures.select(*fig_cols)


# ----------------------------------------------------------- correlation (ST-CO)

def _t_from_r(r, n):
    return r * F.sqrt(F.try_divide(n - 2, F.lit(1.0) - r * r))


def correlation(df: DataFrame, x: str, y: str, group_cols: list[str] = (),
                label_x: str = "X", label_y: str = "Y") -> DataFrame:
    """ST-CO: Pearson and Spearman on pairwise-complete rows, one row per group.

    Everything is taken from one stored row per distinct pair, weighted by its rows. A
    constant variable gives NULL (scipy / pandas: NaN; `corr` raises under ANSI mode).
    """
    d, g = with_group(df, list(group_cols))
    complete = d.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = written(complete.groupBy(*g, x, y).agg(F.count(F.lit(1)).alias("w")), "pairs")
    a, b, w = F.col(x).cast("double"), F.col(y).cast("double"), F.col("w")
    low = pairs.groupBy(*g).agg(F.min(a).alias("__la"), F.min(b).alias("__lb"))
    mean = pairs.join(low, g).groupBy(*g).agg(
        *[(F.min(m) + F.sum(w * (c - F.col(m))) / F.sum(w)).alias(name)
          for c, m, name in ((a, "__la", "__ma"), (b, "__lb", "__mb"))])
    ranked = attach_ranks(pairs, g, {x: "__rx", y: "__ry"}).join(mean, g)
    middle = (F.col("__n") + 1) / F.lit(2.0)

    def r_of(p, q) -> Column:
        return F.try_divide(F.sum(w * p * q), F.sqrt(F.sum(w * p * p)) * F.sqrt(F.sum(w * q * q)))

    a = ranked.groupBy(*g).agg(F.sum("w").alias("n"), r_of(a - F.col("__ma"), b - F.col("__mb")).alias("r"),
                               r_of(F.col("__rx") - middle, F.col("__ry") - middle).alias("rho"))
    n, r, rho = F.col("n"), nan_to_null(F.col("r")), nan_to_null(F.col("rho"))
    ok = n >= 3
    pr = nan_to_null(t_two_sided_p(_t_from_r(r, n), n - 2))
    ps = nan_to_null(t_two_sided_p(_t_from_r(rho, n), n - 2))
    out = a.select(
        *g, n.alias("n_observations"), F.lit(f"{label_x} vs {label_y}").alias("variables"),
        F.when(~ok, F.lit("Insufficient data for correlation")).alias("error"),
        F.when(ok, r).alias("__r"), F.when(ok, rho).alias("__rho"),
        F.when(ok, pr).alias("__pr"), F.when(ok, ps).alias("__ps"))
    r, rho, pr, ps = F.col("__r"), F.col("__rho"), F.col("__pr"), F.col("__ps")
    res = out.select(
        *[c for c in g if c != "__grp"], "n_observations", "variables", "error",
        F.round(r, 4).alias("pearson_r"), F.round(r * r, 4).alias("pearson_r_squared"),
        F.round(pr, 6).alias("pearson_p_value"), (pr < 0.05).alias("pearson_significant"),
        strength_label(r).alias("pearson_interpret"), p_label(pr).alias("pearson_p_interpret"),
        F.round(rho, 4).alias("spearman_rho"), F.round(ps, 6).alias("spearman_p_value"),
        (ps < 0.05).alias("spearman_significant"),
        strength_label(rho).alias("spearman_interpret"), p_label(ps).alias("spearman_p_interpret"),
        (((r > 0) == (rho > 0)) & (F.abs(r - rho) < 0.2)).alias("pearson_spearman_agree"))
    return res


# ---------------------------------------------------------------- mean CI (ST-CI)

def mean_ci(df: DataFrame, value_col: str, group_cols: list[str] = (),
            confidence: float = 0.95) -> DataFrame:
    """ST-CI: t interval for the mean, one row per group."""
    d, g = with_group(df, list(group_cols))
    v = F.col(value_col)
    a = d.groupBy(*g).agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                          F.stddev_samp(v).alias("std"))
    se = F.try_divide(F.col("std"), F.sqrt(F.col("n")))
    a = a.select("*", se.alias("se"),
                 nan_to_null(t_quantile(F.lit(1 - (1 - confidence) / 2), F.col("n") - 1)).alias("t"))
    m = F.col("t") * F.col("se")
    return a.select(*[c for c in g if c != "__grp"], "n",
                    F.round("mean", 4).alias("mean"), F.round("se", 4).alias("std_error"),
                    F.lit(f"{confidence * 100:.0f}%").alias("confidence"),
                    F.round(F.col("mean") - m, 4).alias("lower_ci"),
                    F.round(F.col("mean") + m, 4).alias("upper_ci"),
                    F.round(m, 4).alias("margin_error"), F.round("t", 4).alias("t_critical"))


# ------------------------------------------------- group moments and Levene

def group_moments(df: DataFrame, value_col: str, group_col: str) -> DataFrame:
    """Per group: n, mean, var, median, and the Levene (median-centred) terms."""
    complete = df.where(F.col(value_col).isNotNull() & F.col(group_col).isNotNull())
    d = complete.select(group_col, value_col)
    v = F.col(value_col)
    med = quantiles(prefix_weights(d, [group_col], value_col), [group_col], value_col,
                    {"median": 0.5})
    z = d.join(med, group_col).select(group_col, F.abs(v - F.col("median")).alias("z"), value_col, "median")
    return written(z.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"),
        F.avg("z").alias("z_mean"),
        (F.coalesce(F.var_samp("z"), F.lit(0.0)) * (F.count(F.lit(1)) - 1)).alias("z_ss"),
        F.first("median").alias("median")), "group-moments")


def _centred(moments: DataFrame) -> DataFrame:
    """Per-group rows with the grand means `gm` (of values) and `gz` (of Levene terms),
    so that between-group sums add n (m - grand)^2 and lose no digits to large means."""
    n = F.col("n")
    grand = moments.agg(F.struct(F.try_divide(F.sum(n * F.col("mean")), F.sum(n)).alias("gm"),
                                 F.try_divide(F.sum(n * F.col("z_mean")), F.sum(n)).alias("gz"))).scalar()
    return moments.select("*", grand["gm"].alias("gm"), grand["gz"].alias("gz"))


def _pooled_aggs() -> list:
    """Aggregates over centred per-group rows: N, k, Levene terms and ANOVA sums of squares."""
    n, m, zm = F.col("n"), F.col("mean"), F.col("z_mean")
    return [
        F.sum(n).alias("N"), F.count(F.lit(1)).alias("k"),
        F.sum(n * (zm - F.col("gz")) * (zm - F.col("gz"))).alias("z_between"),
        F.sum("z_ss").alias("z_within"),
        F.sum(n * (m - F.col("gm")) * (m - F.col("gm"))).alias("ssb"),
        F.sum(F.coalesce(F.col("var"), F.lit(0.0)) * (n - 1)).alias("ssw")]


def _levene_stat() -> Column:
    N, k = F.col("N"), F.col("k")
    lev = F.try_divide((N - k) * F.col("z_between"), (k - 1) * F.col("z_within"))
    return nan_to_null(F.when(k > 1, lev))


def _pooled(moments: DataFrame) -> DataFrame:
    """One row of pooled figures (N, k, Levene W, SSB, SSW) from per-group rows."""
    return _centred(moments).agg(*_pooled_aggs()).select("*", _levene_stat().alias("levene_stat"))


def ttest(df: DataFrame, value_col: str, label_col: str, label1: str, label2: str,
          alpha: float = 0.05) -> DataFrame:
    """ST-TT: Levene first (p > .05 -> Student, else Welch), two-sided p, Cohen's d."""
    mo = group_moments(df.where(F.col(label_col).isin(label1, label2)), value_col, label_col)

    def pick(col, lab):
        return F.max(F.when(F.col(label_col) == lab, F.col(col)))

    row = _centred(mo).agg(*[pick(c, lab).alias(f"{c}{i}") for i, lab in ((1, label1), (2, label2))
                   for c in ("n", "mean", "var")], *_pooled_aggs())
    row = row.select("*", _levene_stat().alias("levene_stat"))
    n1, n2, m1, m2 = F.col("n1"), F.col("n2"), F.col("mean1"), F.col("mean2")
    v1, v2 = F.col("var1"), F.col("var2")
    row = row.select("*", nan_to_null(f_upper_p(F.col("levene_stat"), F.lit(1.0), n1 + n2 - 2))
                     .alias("levene_p"))
    equal = F.col("levene_p") > 0.05
    div = F.try_divide
    sp2 = div((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
    t_student = div(m1 - m2, F.sqrt(sp2 * (div(F.lit(1.0), n1) + div(F.lit(1.0), n2))))
    a1, a2 = div(v1, n1), div(v2, n2)
    t_welch = div(m1 - m2, F.sqrt(a1 + a2))
    df_welch = div((a1 + a2) ** 2, div(a1 ** 2, n1 - 1) + div(a2 ** 2, n2 - 1))
    row = row.select("*", F.when(equal, t_student).otherwise(t_welch).alias("t"),
                     F.when(equal, n1 + n2 - 2).otherwise(df_welch).alias("df"),
                     F.sqrt(sp2).alias("pooled_std"))
    row = row.select("*", nan_to_null(t_two_sided_p(F.col("t"), F.col("df"))).alias("p"))
    p = F.col("p")
    cohen = F.when(F.col("pooled_std") > 0, (m1 - m2) / F.col("pooled_std")).otherwise(F.lit(0.0))
    return row.select(
        F.lit(label1).alias("group1_label"), F.lit(label2).alias("group2_label"),
        n1.alias("n1"), n2.alias("n2"), F.round(m1, 4).alias("mean1"), F.round(m2, 4).alias("mean2"),
        F.round(m1 - m2, 4).alias("mean_difference"),
        F.round(F.sqrt(v1), 4).alias("std1"), F.round(F.sqrt(v2), 4).alias("std2"),
        F.round("levene_stat", 4).alias("levene_stat"), F.round("levene_p", 4).alias("levene_p"),
        equal.alias("equal_variance"),
        F.when(equal, "Student's T-Test").otherwise("Welch's T-Test").alias("test_type"),
        F.round("t", 4).alias("t_statistic"), F.round(p, 6).alias("p_value"),
        F.lit(alpha).alias("alpha"), (p < alpha).alias("reject_h0"), (p < alpha).alias("significant"),
        F.round(cohen, 4).alias("cohens_d"), cohens_d_label(cohen).alias("effect_size"))


def anova(df: DataFrame, value_col: str, group_col: str,
          alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """ST-AN: (one-row test result, per-group summaries)."""
    mo = group_moments(df, value_col, group_col)
    N, k = F.col("N"), F.col("k")
    f_stat = F.try_divide(F.try_divide(F.col("ssb"), k - 1), F.try_divide(F.col("ssw"), N - k))
    sst = F.col("ssb") + F.col("ssw")
    r = _pooled(mo).select("*", nan_to_null(f_stat).alias("f"),
                           F.when(sst > 0, F.col("ssb") / sst).otherwise(F.lit(0.0)).alias("eta2"))
    r = r.select("*", nan_to_null(f_upper_p(F.col("f"), k - 1, N - k)).alias("p"),
                 nan_to_null(f_upper_p(F.col("levene_stat"), k - 1, N - k)).alias("levene_p"))
    p = F.col("p")
    result = r.select(
        k.alias("n_groups"), N.alias("total_n"),
        F.round("levene_stat", 4).alias("levene_stat"), F.round("levene_p", 4).alias("levene_p"),
        (F.col("levene_p") > 0.05).alias("homogeneous_var"),
        F.round("f", 4).alias("f_statistic"), F.round(p, 6).alias("p_value"),
        F.lit(alpha).alias("alpha"), (p < alpha).alias("reject_h0"), (p < alpha).alias("significant"),
        F.round("eta2", 4).alias("eta_squared"), eta_label(F.col("eta2")).alias("effect_size"))
    groups = mo.select(group_col, "n", F.round("mean", 2).alias("mean"),
                       F.round(F.sqrt("var"), 2).alias("std"), F.round("median", 2).alias("median"))
    return result, groups


# ------------------------------------------------------------ chi-square (ST-CH)

def chi_square(df: DataFrame, a: str, b: str, alpha: float = 0.05,
               correction: bool = True) -> DataFrame:
    """ST-CH: independence test on the a x b contingency table.

    Only non-empty cells are materialised; no row x column grid is built.
    With E = r c / N: chi2 = N * sum(O^2 / (r c)) - N over non-empty cells;
    the sum of 1/E over all cells is N * sum(1/r) * sum(1/c); cells with
    E < 5 are counted from the column margins below each row's integer
    threshold (a distributed prefix count). Yates' correction applies when
    dof = 1 (2 x 2), where every cell has |O - E| = |O11 N - r1 c1| / N.
    Scalars (N, first categories) enter as scalar subqueries.
    """
    cells = written(df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
                    .groupBy(a, b).agg(F.count(F.lit(1)).alias("o")), "cells")
    rows = cells.groupBy(a).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(b).agg(F.sum("o").alias("c"))
    # each margin table is summarised once, as one struct-valued scalar subquery
    mr = rows.agg(F.struct(F.sum("r").alias("N"), F.count(F.lit(1)).alias("kr"),
                           F.min("r").alias("rmin"), F.sum(F.lit(1.0) / F.col("r")).alias("inv_r"),
                           F.min_by("r", F.col(a)).alias("r1"), F.min(a).alias("a1"))).scalar()
    mc = cols.agg(F.struct(F.count(F.lit(1)).alias("kc"), F.min("c").alias("cmin"),
                           F.sum(F.lit(1.0) / F.col("c")).alias("inv_c"),
                           F.min_by("c", F.col(b)).alias("c1"), F.min(b).alias("b1"))).scalar()
    j = cells.join(rows, a).join(cols, b)
    one = j.agg(F.sum(F.col("o") / F.col("r") * F.col("o") / F.col("c")).alias("o2_rc"),
                F.sum(F.when((F.col(a) == mr["a1"]) & (F.col(b) == mc["b1"]), F.col("o")))
                .alias("o11"))
    one = one.select(
        "*", mr["N"].alias("N"), mr["kr"].alias("kr"), mc["kc"].alias("kc"),
        mr["rmin"].alias("rmin"), mc["cmin"].alias("cmin"), mr["inv_r"].alias("inv_r"),
        mc["inv_c"].alias("inv_c"), mr["r1"].alias("r1"), mc["c1"].alias("c1"),
        _cells_below(rows, cols, mr["N"]).scalar().alias("cells_below_5"))
    N, kr, kc = F.col("N"), F.col("kr"), F.col("kc")
    dof = (kr - 1) * (kc - 1)
    chi2_plain = N * F.col("o2_rc") - N
    diff = F.abs(F.coalesce(F.col("o11"), F.lit(0)) * N - F.col("r1") * F.col("c1")) / N
    yates = (diff - F.least(diff, F.lit(0.5))) ** 2 * N * F.col("inv_r") * F.col("inv_c")
    chi2 = (F.when(dof == 0, F.lit(0.0))
            .when((dof == 1) & F.lit(correction), yates).otherwise(chi2_plain))
    one = one.select("*", dof.alias("dof"), chi2.alias("chi2"))
    one = one.select("*", F.when(F.col("dof") == 0, F.lit(1.0))
                     .otherwise(nan_to_null(chi2_upper_p(F.col("chi2"), F.col("dof")))).alias("p"))
    kmin = F.least(kr, kc) - 1
    v = F.when(N * kmin > 0, F.sqrt(F.col("chi2") / (N * kmin))).otherwise(F.lit(0.0))
    min_e = F.col("rmin") * F.col("cmin") / N
    p = F.col("p")
    return one.select(
        F.round("chi2", 4).alias("chi2_statistic"), F.col("dof").alias("degrees_of_freedom"),
        F.round(p, 6).alias("p_value"), F.lit(alpha).alias("alpha"),
        (p < alpha).alias("reject_h0"), (p < alpha).alias("significant"),
        N.alias("n_total"), F.round(min_e, 2).alias("min_expected_freq"),
        F.col("cells_below_5"), (kr * kc).alias("total_cells"), (min_e >= 5).alias("assumption_met"),
        F.round(v, 4).alias("cramers_v"), cramers_v_label(v).alias("effect_size"))


def _cells_below(rows: DataFrame, cols: DataFrame, n_total: Column) -> DataFrame:
    """Cells with expected count < 5: r c < 5N  <=>  c < floor((5N - 1) / r) + 1.

    Row thresholds (weight 0) and column margins (weight 1) are ranked
    together; a threshold's `before` is the number of column margins
    strictly below it.
    """
    thr = rows.select((F.floor((F.lit(5) * n_total - 1) / F.col("r")) + 1).cast("double").alias("v"),
                      F.lit(0).cast("bigint").alias("wt"))
    cv = cols.select(F.col("c").cast("double").alias("v"), F.lit(1).cast("bigint").alias("wt"))
    both, g = with_group(thr.unionByName(cv), [])
    pw = prefix_weights(both, g, "v", weight=F.col("wt"))
    return thr.join(pw.select("v", "before"), "v").agg(
        F.coalesce(F.sum("before"), F.lit(0)).alias("cells_below_5"))
