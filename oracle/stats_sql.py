"""Oracle SQL for the statistics; p-values and t quantiles by `tails_sql`."""

from __future__ import annotations

from .ctes import R, sql
from .tails_sql import chi2_upper, f_upper, p_label, t_two_sided


def QTAB(src: str, grp: str, x: str, probs: dict[str, float]) -> str:
    """Exact quantiles by order statistics with numpy's interpolation."""
    cols = []
    for name, p in probs.items():
        h = f"((n - 1) * CAST({p} AS DOUBLE))"
        lo = f"max(CASE WHEN i = floor({h}) THEN x END)"
        hi = f"max(CASE WHEN i = ceil({h}) THEN x END)"
        t = f"max({h} - floor({h}))"
        cols.append(f"CASE WHEN {t} >= 0.5 THEN {hi} - ({hi} - {lo}) * (1.0 - {t}) "
                    f"ELSE {lo} + ({hi} - {lo}) * {t} END AS {name}")
    return (f"SELECT grp, {', '.join(cols)} FROM (SELECT {grp} AS grp, {x} AS x, "
            f"row_number() OVER (PARTITION BY {grp} ORDER BY {x}) - 1 AS i, "
            f"count(*) OVER (PARTITION BY {grp}) AS n FROM {src} WHERE {x} IS NOT NULL) GROUP BY grp")

_X = "production_tonnes"


def descriptive(src: str = "fct_production", grp: str = "item_code") -> str:
    x = _X
    metrics = [
        ("Count (non-null)", "CAST(n AS DOUBLE)"), ("Missing (%)", R("(rows_ - n) / rows_ * 100", 2)),
        ("Mean", R("mean", 2)), ("Median", R("median", 2)), ("Mode (approx)", R("mode", 2)),
        ("Std Dev", R("std", 2)), ("IQR", R("p75 - p25", 2)),
        ("Coeff of Variation (CV)", f"CASE WHEN mean <> 0 THEN {R('std / mean', 4)} END"),
        ("Min", R("mn", 2)), ("P5", R("p5", 2)), ("P25", R("p25", 2)), ("P75", R("p75", 2)),
        ("P95", R("p95", 2)), ("Max", R("mx", 2)),
        ("Skewness", R("m3 / pow(m2, 1.5)", 4)), ("Kurtosis (excess)", R("m4 / (m2 * m2) - 3", 4)),
    ]
    selects = "\n  UNION ALL\n  ".join(
        f"SELECT {grp}, {i + 1} AS metric_order, '{name}' AS metric, CAST({expr} AS DOUBLE) AS value, "
        f"'{x}' AS variable FROM fig" for i, (name, expr) in enumerate(metrics))
    return sql(f"""
  SELECT * FROM (
  WITH f AS (
    SELECT {grp}, count(*) AS rows_, count({x}) AS n, avg({x}) AS mean, stddev_samp({x}) AS std,
           min({x}) AS mn, max({x}) AS mx, q.p5, q.p25, q.median, q.p75, q.p95
    FROM {src} LEFT JOIN ({QTAB(src, grp, x, {'p5': 0.05, 'p25': 0.25, 'median': 0.5, 'p75': 0.75, 'p95': 0.95})}) q
      ON {grp} = q.grp
    GROUP BY {grp}, q.p5, q.p25, q.median, q.p75, q.p95),
  mom AS (
    SELECT p.{grp}, avg(pow(p.{x} - f.mean, 2)) AS m2, avg(pow(p.{x} - f.mean, 3)) AS m3,
           avg(pow(p.{x} - f.mean, 4)) AS m4
    FROM {src} p JOIN f ON p.{grp} = f.{grp}
    WHERE p.{x} IS NOT NULL GROUP BY p.{grp}),
  md AS (
    SELECT {grp}, min({x}) AS mode FROM (
      SELECT {grp}, {x}, count(*) AS c, max(count(*)) OVER (PARTITION BY {grp}) AS mc
      FROM {src} WHERE {x} IS NOT NULL GROUP BY {grp}, {x}) WHERE c = mc
    GROUP BY {grp}),
  fig AS (SELECT * FROM f LEFT JOIN mom USING ({grp}) LEFT JOIN md USING ({grp}))
  {selects})""", src)


def outliers() -> str:
    x = "yield_kg_ha"
    lo, hi = "q1 - CAST(1.5 AS DOUBLE) * (q3 - q1)", "q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)"
    out = f"p.{x} < {lo} OR p.{x} > {hi}"
    return sql(f"""
  SELECT q.item_code, {R('q1', 2)} AS q1, {R('q3', 2)} AS q3, {R('q3 - q1', 2)} AS iqr,
         {R(lo, 2)} AS lower_bound, {R(hi, 2)} AS upper_bound,
         count(*) FILTER (WHERE {out}) AS n_outliers,
         {R(f'count(*) FILTER (WHERE {out}) * CAST(100.0 AS DOUBLE) / count(*)', 2)} AS pct_outliers
  FROM fct_production p
  JOIN (SELECT grp AS item_code, q1, q3 FROM ({QTAB('fct_production', 'item_code', x, {'q1': 0.25, 'q3': 0.75})})) q
    ON p.item_code = q.item_code
  GROUP BY q.item_code, q.q1, q.q3""", "fct_production")


def outlier_rows() -> str:
    x = "yield_kg_ha"
    return sql(f"""
  SELECT p.production_sk, coalesce(p.{x} < q1 - CAST(1.5 AS DOUBLE) * (q3 - q1)
                                   OR p.{x} > q3 + CAST(1.5 AS DOUBLE) * (q3 - q1), false) AS is_outlier
  FROM fct_production p
  LEFT JOIN ({QTAB('fct_production', 'item_code', x, {'q1': 0.25, 'q3': 0.75})}) q ON p.item_code = q.grp""", "fct_production")


def correlation_core() -> str:
    def avg_rank(c):
        return (f"rank() OVER (PARTITION BY item_code ORDER BY {c}) + "
                f"(count(*) OVER (PARTITION BY item_code, {c}) - 1) / CAST(2.0 AS DOUBLE)")
    return sql(f"""
  SELECT item_code, count(*) AS n_observations,
         CASE WHEN count(*) >= 3 THEN {R('corr(x, y)', 4)} END AS pearson_r,
         CASE WHEN count(*) >= 3 THEN {R('corr(rx, ry)', 4)} END AS spearman_rho
  FROM (SELECT item_code, x, y, {avg_rank('x')} AS rx, {avg_rank('y')} AS ry
        FROM (SELECT item_code, area_harvested_ha AS x, production_tonnes AS y FROM fct_production
              WHERE area_harvested_ha IS NOT NULL AND production_tonnes IS NOT NULL))
  GROUP BY item_code""", "fct_production")


def _strength(v: str) -> str:
    a = f"abs({v})"
    return (f"CASE WHEN {v} IS NULL THEN NULL ELSE "
            f"(CASE WHEN {a} >= 0.90 THEN 'very strong' WHEN {a} >= 0.70 THEN 'strong' "
            f"WHEN {a} >= 0.50 THEN 'moderate' WHEN {a} >= 0.30 THEN 'weak' "
            f"ELSE 'very weak / negligible' END) || ' ' || "
            f"(CASE WHEN {v} > 0 THEN 'positive' ELSE 'negative' END) || ' correlation' END")


def correlation_labels() -> str:
    """ST-LB.core: r squared, strength labels and agreement, from unrounded r and rho."""
    def avg_rank(c):
        return (f"rank() OVER (PARTITION BY item_code ORDER BY {c}) + "
                f"(count(*) OVER (PARTITION BY item_code, {c}) - 1) / CAST(2.0 AS DOUBLE)")
    return sql(f"""
  SELECT item_code, {R('r * r', 4)} AS pearson_r_squared,
         {_strength('r')} AS pearson_interpret, {_strength('rho')} AS spearman_interpret,
         ((r > 0) = (rho > 0)) AND abs(r - rho) < 0.2 AS pearson_spearman_agree
  FROM (SELECT item_code,
               CASE WHEN count(*) >= 3 AND NOT isnan(corr(x, y)) THEN corr(x, y) END AS r,
               CASE WHEN count(*) >= 3 AND NOT isnan(corr(rx, ry)) THEN corr(rx, ry) END AS rho
        FROM (SELECT item_code, x, y, {avg_rank('x')} AS rx, {avg_rank('y')} AS ry
              FROM (SELECT item_code, area_harvested_ha AS x, production_tonnes AS y
                    FROM fct_production
                    WHERE area_harvested_ha IS NOT NULL AND production_tonnes IS NOT NULL))
        GROUP BY item_code)""", "fct_production")


def ci_core() -> str:
    x = "des_kcal_cap_day"
    return sql(f"""
  SELECT year, count({x}) AS n, {R(f'avg({x})', 4)} AS mean,
         {R(f'stddev_samp({x}) / sqrt(count({x}))', 4)} AS std_error
  FROM fct_food_security GROUP BY year""", "fct_food_security")


_GROUPS = """
  g AS (SELECT {grp} AS grp, des_kcal_cap_day AS x FROM rpt_food_security_dashboard
        WHERE des_kcal_cap_day IS NOT NULL AND {grp} IS NOT NULL {extra}),
  med AS (SELECT grp, CASE WHEN t >= 0.5 THEN hi - (hi - lo) * (1.0 - t) ELSE lo + (hi - lo) * t END AS median
          FROM (SELECT grp, max(CASE WHEN i = floor((n - 1) * 0.5) THEN x END) AS lo,
                       max(CASE WHEN i = ceil((n - 1) * 0.5) THEN x END) AS hi,
                       max((n - 1) * 0.5 - floor((n - 1) * 0.5)) AS t
                FROM (SELECT grp, x, row_number() OVER (PARTITION BY grp ORDER BY x) - 1 AS i,
                             count(*) OVER (PARTITION BY grp) AS n FROM g) GROUP BY grp)),
  z AS (SELECT g.grp, g.x, abs(g.x - med.median) AS z FROM g JOIN med ON g.grp = med.grp),
  gs AS (SELECT grp, count(*) AS n, avg(x) AS mean, var_samp(x) AS var, avg(z) AS zm,
                sum(z) AS zs FROM z GROUP BY grp),
  zw AS (SELECT z.grp, sum(pow(z.z - gs.zm, 2)) AS zss FROM z JOIN gs ON z.grp = gs.grp GROUP BY z.grp),
  tot AS (SELECT sum(n) AS N, count(*) AS k, sum(zs) / sum(n) AS zbar,
                 sum(n * mean) / sum(n) AS gbar FROM gs),
  pooled AS (SELECT tot.N, tot.k,
                    (tot.N - tot.k) / (tot.k - 1) * sum(gs.n * pow(gs.zm - tot.zbar, 2)) / sum(zw.zss) AS levene,
                    sum(gs.n * pow(gs.mean - tot.gbar, 2)) AS ssb,
                    sum((gs.n - 1) * coalesce(gs.var, 0)) AS ssw
             FROM gs JOIN zw ON gs.grp = zw.grp, tot GROUP BY tot.N, tot.k)"""


def _bands(x: str, cuts: list[float], labels: list[str]) -> str:
    """CASE over ascending cut points; NULL falls through to the last label, as in Spark."""
    arms = " ".join(f"WHEN {x} < {c} THEN '{lab}'" for c, lab in zip(cuts, labels))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


# Effect-size bands (Cohen's d, eta squared, Cramer's V).
D_LABELS = ["negligible effect", "small effect", "medium effect", "large effect"]
V_LABELS = ["negligible association", "small association", "medium association",
            "large association"]


def ttest_core(l1: str, l2: str) -> str:
    body = _GROUPS.format(grp="development_status",
                          extra=f"AND development_status IN ('{l1}', '{l2}')")
    sp = "sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2))"
    return sql(f"""
  SELECT * FROM (WITH {body}
  SELECT a.n AS n1, b.n AS n2, {R('a.mean', 4)} AS mean1, {R('b.mean', 4)} AS mean2,
         {R('a.mean - b.mean', 4)} AS mean_difference, {R('sqrt(a.var)', 4)} AS std1,
         {R('sqrt(b.var)', 4)} AS std2, {R('pooled.levene', 4)} AS levene_stat,
         {R(f'CASE WHEN {sp} > 0 THEN (a.mean - b.mean) / {sp} ELSE 0 END', 4)} AS cohens_d,
         {_bands(f'abs(CASE WHEN {sp} > 0 THEN (a.mean - b.mean) / {sp} ELSE 0 END)',
                 [0.20, 0.50, 0.80], D_LABELS)} AS effect_size
  FROM gs a, gs b, pooled WHERE a.grp = '{l1}' AND b.grp = '{l2}')""",
               "rpt_food_security_dashboard")


def anova_core() -> str:
    body = _GROUPS.format(grp="income_group", extra="")
    return sql(f"""
  SELECT * FROM (WITH {body}
  SELECT k AS n_groups, CAST(N AS BIGINT) AS total_n, {R('levene', 4)} AS levene_stat,
         {R('(ssb / (k - 1)) / (ssw / (N - k))', 4)} AS f_statistic,
         {R('CASE WHEN ssb + ssw > 0 THEN ssb / (ssb + ssw) ELSE 0 END', 4)} AS eta_squared,
         {_bands('CASE WHEN ssb + ssw > 0 THEN ssb / (ssb + ssw) ELSE 0 END',
                 [0.01, 0.06, 0.14], D_LABELS)} AS effect_size
  FROM pooled)""", "rpt_food_security_dashboard")


def anova_groups() -> str:
    body = _GROUPS.format(grp="income_group", extra="")
    return sql(f"""
  SELECT * FROM (WITH {body}
  SELECT gs.grp AS income_group, gs.n, {R('gs.mean', 2)} AS mean, {R('sqrt(gs.var)', 2)} AS std,
         {R('med.median', 2)} AS median
  FROM gs JOIN med ON gs.grp = med.grp)""", "rpt_food_security_dashboard")


def chi_core(a: str, b: str, yates: bool) -> str:
    obs = "o + least(0.5, abs(e - o)) * sign(e - o)" if yates else "o"
    v = "CASE WHEN N * (least(kr, kc) - 1) > 0 THEN sqrt(chi2 / (N * (least(kr, kc) - 1))) ELSE 0 END"
    return sql(f"""
  SELECT * FROM (
  WITH cells AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM rpt_food_security_dashboard
                 WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
       r AS (SELECT a, sum(o) AS r FROM cells GROUP BY a),
       c AS (SELECT b, sum(o) AS c FROM cells GROUP BY b),
       n AS (SELECT sum(o) AS N FROM cells),
       grid AS (SELECT r.a, c.b, CAST(r.r * c.c AS DOUBLE) / n.N AS e,
                       CAST(coalesce(cells.o, 0) AS DOUBLE) AS o, n.N
                FROM r CROSS JOIN c CROSS JOIN n
                LEFT JOIN cells ON cells.a = r.a AND cells.b = c.b),
       s AS (SELECT sum(pow(({obs}) - e, 2) / e) AS chi2, count(DISTINCT a) AS kr,
                    count(DISTINCT b) AS kc, min(e) AS min_e, count(*) FILTER (WHERE e < 5) AS below,
                    count(*) AS cells_, max(N) AS N FROM grid)
  SELECT {R('chi2', 4)} AS chi2_statistic, (kr - 1) * (kc - 1) AS degrees_of_freedom,
         CAST(N AS BIGINT) AS n_total, {R('min_e', 2)} AS min_expected_freq, below AS cells_below_5,
         cells_ AS total_cells, min_e >= 5 AS assumption_met,
         {R(v, 4)} AS cramers_v, {_bands(v, [0.10, 0.30, 0.50], V_LABELS)} AS effect_size
  FROM s)""", "rpt_food_security_dashboard")


def _correlations() -> str:
    """Unrounded r, rho and their two-sided p per item."""
    def avg_rank(c):
        return (f"rank() OVER (PARTITION BY item_code ORDER BY {c}) + "
                f"(count(*) OVER (PARTITION BY item_code, {c}) - 1) / CAST(2.0 AS DOUBLE)")
    ok = "CASE WHEN n >= 3 AND NOT isnan({0}) THEN {0} END"
    p = "CASE WHEN {0} IS NOT NULL AND n > 2 AND abs({0}) < 1 THEN " + t_two_sided("{0} * sqrt((n - 2) / (1 - {0} * {0}))", "n - 2") + " END"
    return f"""
  c0 AS (SELECT item_code, count(*) AS n, corr(x, y) AS r, corr(rx, ry) AS rho
         FROM (SELECT item_code, x, y, {avg_rank('x')} AS rx, {avg_rank('y')} AS ry
               FROM (SELECT item_code, area_harvested_ha AS x, production_tonnes AS y FROM fct_production
                     WHERE area_harvested_ha IS NOT NULL AND production_tonnes IS NOT NULL))
         GROUP BY item_code),
  c1 AS (SELECT item_code, n, {ok.format('r')} AS r, {ok.format('rho')} AS rho FROM c0),
  c AS (SELECT *, {p.format('r')} AS pr, {p.format('rho')} AS ps FROM c1)"""


def correlation_full() -> str:
    return sql(f"""
  SELECT * FROM (WITH {_correlations()}
  SELECT item_code, n AS n_observations, 'area_harvested_ha vs production_tonnes' AS variables,
         CASE WHEN n < 3 THEN 'Insufficient data for correlation' END AS error,
         {R('r', 4)} AS pearson_r, {R('r * r', 4)} AS pearson_r_squared, {R('pr', 6)} AS pearson_p_value,
         pr < 0.05 AS pearson_significant, {_strength('r')} AS pearson_interpret, {p_label('pr')} AS pearson_p_interpret,
         {R('rho', 4)} AS spearman_rho, {R('ps', 6)} AS spearman_p_value, ps < 0.05 AS spearman_significant,
         {_strength('rho')} AS spearman_interpret, {p_label('ps')} AS spearman_p_interpret,
         ((r > 0) = (rho > 0)) AND abs(r - rho) < 0.2 AS pearson_spearman_agree FROM c)""", "fct_production")


def correlation_p_labels() -> str:
    return sql(f"""
  SELECT * FROM (WITH {_correlations()}
  SELECT item_code, {_strength('r')} AS pearson_interpret, {p_label('pr')} AS pearson_p_interpret,
         {_strength('rho')} AS spearman_interpret, {p_label('ps')} AS spearman_p_interpret FROM c)""", "fct_production")


def ci_full() -> str:
    """The critical value by halving a bracket until its ends meet to 1e-9."""
    x = "des_kcal_cap_day"
    return sql(f"""
  SELECT * FROM (WITH RECURSIVE
  s AS (SELECT year, count({x}) AS n, avg({x}) AS mean, stddev_samp({x}) / sqrt(count({x})) AS se
        FROM fct_food_security GROUP BY year),
  d AS (SELECT DISTINCT n - 1 AS df FROM s WHERE n > 1),
  b AS (SELECT df, CAST(0 AS DOUBLE) AS lo, CAST(16 AS DOUBLE) AS hi, 0 AS step FROM d
        UNION ALL
        SELECT df, CASE WHEN p > 0.05 THEN mid ELSE lo END, CASE WHEN p > 0.05 THEN hi ELSE mid END, step + 1
        FROM (SELECT df, lo, hi, (lo + hi) / 2 AS mid, step, {t_two_sided('(lo + hi) / 2', 'df')} AS p
              FROM b WHERE step < 34)),
  q AS (SELECT df, (lo + hi) / 2 AS t FROM b WHERE step = 34)
  SELECT year, n, {R('mean', 4)} AS mean, {R('se', 4)} AS std_error, '95%' AS confidence,
         {R('mean - t * se', 4)} AS lower_ci, {R('mean + t * se', 4)} AS upper_ci,
         {R('t * se', 4)} AS margin_error, {R('t', 4)} AS t_critical
  FROM s LEFT JOIN q ON q.df = s.n - 1)""", "fct_food_security")


def ttest_full(l1: str, l2: str) -> str:
    body = _GROUPS.format(grp="development_status",
                          extra=f"AND development_status IN ('{l1}', '{l2}')")
    return sql(f"""
  SELECT * FROM (WITH {body},
  u AS (SELECT a.n AS n1, b.n AS n2, a.mean AS m1, b.mean AS m2, a.var AS v1, b.var AS v2, pooled.levene AS lev,
               sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2)) AS sp
        FROM gs a, gs b, pooled WHERE a.grp = '{l1}' AND b.grp = '{l2}'),
  l AS (SELECT *, {f_upper('lev', '1', 'n1 + n2 - 2')} AS lp FROM u),
  w AS (SELECT *, CASE WHEN lp > 0.05 THEN (m1 - m2) / (sp * sqrt(1.0 / n1 + 1.0 / n2))
                       ELSE (m1 - m2) / sqrt(v1 / n1 + v2 / n2) END AS t,
               CASE WHEN lp > 0.05 THEN n1 + n2 - 2
                    ELSE pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) END AS df FROM l),
  fin AS (SELECT *, {t_two_sided('t', 'df')} AS p, CASE WHEN sp > 0 THEN (m1 - m2) / sp ELSE 0 END AS d FROM w)
  SELECT '{l1}' AS group1_label, '{l2}' AS group2_label, n1, n2, {R('m1', 4)} AS mean1, {R('m2', 4)} AS mean2,
         {R('m1 - m2', 4)} AS mean_difference, {R('sqrt(v1)', 4)} AS std1, {R('sqrt(v2)', 4)} AS std2,
         {R('lev', 4)} AS levene_stat, {R('lp', 4)} AS levene_p, lp > 0.05 AS equal_variance,
         CASE WHEN lp > 0.05 THEN 'Student''s T-Test' ELSE 'Welch''s T-Test' END AS test_type,
         {R('t', 4)} AS t_statistic, {R('p', 6)} AS p_value, CAST(0.05 AS DOUBLE) AS alpha, p < 0.05 AS reject_h0,
         p < 0.05 AS significant, {R('d', 4)} AS cohens_d, {_bands('abs(d)', [0.20, 0.50, 0.80], D_LABELS)} AS effect_size
  FROM fin)""", "rpt_food_security_dashboard")


def anova_full() -> str:
    body = _GROUPS.format(grp="income_group", extra="")
    return sql(f"""
  SELECT * FROM (WITH {body},
  u AS (SELECT *, (ssb / (k - 1)) / (ssw / (N - k)) AS f, CASE WHEN ssb + ssw > 0 THEN ssb / (ssb + ssw) ELSE 0 END AS e FROM pooled),
  fin AS (SELECT *, {f_upper('f', 'k - 1', 'N - k')} AS p, {f_upper('levene', 'k - 1', 'N - k')} AS lp FROM u)
  SELECT k AS n_groups, CAST(N AS BIGINT) AS total_n, {R('levene', 4)} AS levene_stat, {R('lp', 4)} AS levene_p,
         lp > 0.05 AS homogeneous_var, {R('f', 4)} AS f_statistic, {R('p', 6)} AS p_value, CAST(0.05 AS DOUBLE) AS alpha,
         p < 0.05 AS reject_h0, p < 0.05 AS significant, {R('e', 4)} AS eta_squared,
         {_bands('e', [0.01, 0.06, 0.14], D_LABELS)} AS effect_size FROM fin)""", "rpt_food_security_dashboard")


def chi_full(a: str, b: str) -> str:
    v = "CASE WHEN N * (least(kr, kc) - 1) > 0 THEN sqrt(chi2 / (N * (least(kr, kc) - 1))) ELSE 0 END"
    return sql(f"""
  SELECT * FROM (
  WITH g AS (SELECT {a} AS a, {b} AS b FROM rpt_food_security_dashboard WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
       ra AS (SELECT a, count(*) AS m FROM g GROUP BY a), cb AS (SELECT b, count(*) AS m FROM g GROUP BY b),
       grid AS (SELECT ra.a, cb.b, CAST(ra.m AS DOUBLE) * cb.m / (SELECT count(*) FROM g) AS e,
                       (SELECT count(*) FROM g WHERE g.a = ra.a AND g.b = cb.b) AS o FROM ra, cb),
       s AS (SELECT sum(pow(o - e, 2) / e) AS chi2, count(DISTINCT a) AS kr, count(DISTINCT b) AS kc, min(e) AS min_e,
                    count(*) FILTER (WHERE e < 5) AS below, count(*) AS cells_, (SELECT count(*) FROM g) AS N FROM grid),
       z AS (SELECT *, {chi2_upper('chi2', '(kr - 1) * (kc - 1)')} AS p FROM s)
  SELECT {R('chi2', 4)} AS chi2_statistic, (kr - 1) * (kc - 1) AS degrees_of_freedom, {R('p', 6)} AS p_value,
         CAST(0.05 AS DOUBLE) AS alpha, p < 0.05 AS reject_h0, p < 0.05 AS significant, CAST(N AS BIGINT) AS n_total,
         {R('min_e', 2)} AS min_expected_freq, below AS cells_below_5, cells_ AS total_cells, min_e >= 5 AS assumption_met,
         {R(v, 4)} AS cramers_v, {_bands(v, [0.10, 0.30, 0.50], V_LABELS)} AS effect_size
  FROM z)""", "rpt_food_security_dashboard")


def all_stats_sql() -> dict[str, str]:
    return {
        "ST-DS": descriptive(),
        "ST-DS.fine": descriptive("int_production_fine", "year"),
        "ST-OI": outliers(),
        "ST-OI.rows": outlier_rows(),
        "ST-CO": correlation_full(),
        "ST-LB": correlation_p_labels(),
        "ST-CI": ci_full(),
        "ST-TT": ttest_full("Developed/Emerging", "Developing/LDC"),
        "ST-AN": anova_full(),
        "ST-CH": chi_full("income_group", "des_category"),
        "ST-CO.core": correlation_core(),
        "ST-LB.core": correlation_labels(),
        "ST-CI.core": ci_core(),
        "ST-TT.core": ttest_core("Developed/Emerging", "Developing/LDC"),
        "ST-AN.core": anova_core(),
        "ST-AN.groups": anova_groups(),
        "ST-CH.core": chi_core("income_group", "des_category", yates=False),
        "ST-CH.2x2": chi_core("is_food_secure", "is_notable_event_year", yates=True),
    }
