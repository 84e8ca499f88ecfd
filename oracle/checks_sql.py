"""Oracle SQL for the raw checks (B) and the data tests (DQ)."""

from __future__ import annotations

from cropflow.plans import dq_suite

from .ctes import R, WS, sql

RAW_CTE = {"production": "production_raw", "trade": "trade_raw", "fbs": "fbs_raw"}

# Fixed values, stated here independently of the code under test:
# elements, first and last year, least rows, largest share of negative values.
EXPECTED = {
    "production": (["Production", "Area harvested", "Yield"], 1961, 2022, 1_000_000, 0.01),
    "trade": (["Export Quantity", "Export Value", "Import Quantity", "Import Value"], 1986, 2022, 500_000, 0.01),
    "fbs": (["Food supply (kcal/capita/day)", "Protein supply quantity (g/capita/day)",
             "Fat supply quantity (g/capita/day)"], 2010, 2022, 50_000, 0.05),
}
FLAG = f"upper(trim(coalesce(CAST(Flag AS VARCHAR), ''), {WS}))"
TEXT = "CAST({} AS VARCHAR)".format


def _check(name: str, check: str) -> str:
    """One check of one raw table as its own query: a status and a detail."""
    elements, first, last, least, negative = EXPECTED[name]
    raw = RAW_CTE[name]
    if check == "COLUMNS_PRESENT":
        status, detail, source = "'PASS'", "'extra='", f"(SELECT 1 FROM {raw} LIMIT 1)"
    elif check == "ROW_COUNT":
        source = f"(SELECT count(*) AS n FROM {raw})"
        status, detail = f"if(n >= {least}, 'PASS', 'FAIL')", f"'rows=' || {TEXT('n')} || ' min={least}'"
    elif check == "PK_UNIQUENESS":
        source = f"""(SELECT count(*) AS n, count(*) - count(DISTINCT (Area_Code, Item_Code, Element_Code, Year)) AS d FROM {raw})"""
        status, detail = "if(d = 0, 'PASS', 'FAIL')", f"'duplicates=' || {TEXT('d')} || ' rows=' || {TEXT('n')}"
    elif check == "YEAR_RANGE":
        source = f"(SELECT min(Year) AS a, max(Year) AS z FROM {raw})"
        status = f"if(a <= {first} AND z >= {last}, 'PASS', 'WARN')"
        detail = f"'years=' || {TEXT('a')} || '-' || {TEXT('z')} || ' required={first}-{last}'"
    elif check == "ELEMENTS_PRESENT":
        listed = ", ".join(f"({i}, '{e}')" for i, e in enumerate(elements))
        source = f"""(SELECT coalesce(string_agg(w.e, ', ' ORDER BY w.i), '') AS m FROM (VALUES {listed}) w(i, e)
                      WHERE NOT EXISTS (SELECT 1 FROM {raw} r WHERE contains(lower(r.Element), lower(w.e))))"""
        status, detail = "if(m = '', 'PASS', 'WARN')", "'missing=' || m"
    elif check == "NEGATIVE_VALUES":
        source = f"(SELECT count(Value) AS nn, count(*) FILTER (WHERE Value < 0) AS neg FROM {raw})"
        status = f"if(nn = 0, 'WARN', if(neg / nn <= {negative}, 'PASS', 'FAIL'))"
        detail = f"'negative=' || {TEXT('neg')} || ' non_null=' || {TEXT('nn')}"
    elif check == "FLAG_DIST":
        source = f"""(SELECT count(*) AS n, count(*) FILTER (WHERE {FLAG} = 'M') AS m,
                      count(*) FILTER (WHERE {FLAG} = '') AS o FROM {raw})"""
        status = "if(m * 100.0 / n > 50, 'FAIL', if(m * 100.0 / n > 30, 'WARN', 'PASS'))"
        detail = f"'missing=' || {TEXT('m')} || ' official=' || {TEXT('o')} || ' rows=' || {TEXT('n')}"
    else:
        source = f"""(SELECT count(*) FILTER (WHERE Area_Code < 1000) AS c,
                      count(*) FILTER (WHERE Area_Code >= 1000) AS g FROM {raw})"""
        status = "if(g = 0, 'WARN', if(c = 0, 'FAIL', 'PASS'))"
        detail = f"'countries=' || {TEXT('c')} || ' aggregates=' || {TEXT('g')}"
    return f"SELECT '{name}' AS dataset, '{check}' AS \"check\", {status} AS status, {detail} AS detail FROM {source}"


CHECK_IDS = {"B03": "COLUMNS_PRESENT", "B04": "ROW_COUNT", "B05": "PK_UNIQUENESS", "B06": "YEAR_RANGE",
             "B07": "ELEMENTS_PRESENT", "B08": "NEGATIVE_VALUES", "B09": "FLAG_DIST", "B10": "AREA_TYPES"}


def _union(parts) -> str:
    return "\n  UNION ALL\n  ".join(parts)


SUITE = "(" + _union(_check(n, c) for n in RAW_CTE for c in CHECK_IDS.values()) + ")"


def lacking_sql() -> str:
    """The suite over tables without Flag, Element and Year."""
    parts = []
    for name, raw in RAW_CTE.items():
        parts += [_check(name, c) for c in ("ROW_COUNT", "NEGATIVE_VALUES", "AREA_TYPES")]
        parts.append(f"SELECT '{name}', 'COLUMNS_PRESENT', 'FAIL', 'missing=Element,Flag,Year'")
        parts += [f"SELECT '{name}', '{c}', 'WARN', 'no column {col}'" for c, col in
                  (("YEAR_RANGE", "Year"), ("ELEMENTS_PRESENT", "Element"), ("FLAG_DIST", "Flag"))]
        parts.append(f"""SELECT '{name}', 'PK_UNIQUENESS', if(d = 0, 'PASS', 'FAIL'), 'duplicates=' || {TEXT('d')} || ' rows=' || {TEXT('n')}
          FROM (SELECT count(*) AS n, count(*) - count(DISTINCT (Area_Code, Item_Code, Element_Code)) AS d FROM {raw})""")
    return sql(f"SELECT * FROM ({_union(parts)})", *RAWS)


RAWS = list(RAW_CTE.values())


def suite_sql() -> str:
    return sql(f"SELECT * FROM {SUITE}", *RAWS)


def file_suite_sql() -> str:
    """The suite on files: rows of existence and encoding before the checks, and three files that stop early."""
    parts = []
    for k, t in enumerate(RAW_CTE):
        parts.append(f"SELECT '{t}' AS dataset, 'FILE_EXISTS' AS \"check\", 'PASS' AS status, '' AS detail, {k} AS run")
        parts.append(f"SELECT '{t}', 'ENCODING', 'PASS', 'utf-8', {k}")
        parts.append(f"SELECT dataset, \"check\", status, detail, {k} FROM {SUITE} WHERE dataset = '{t}'")
    parts += ["SELECT 'production', 'FILE_EXISTS', 'FAIL', 'not found', 3", "SELECT 'trade', 'FILE_SIZE', 'FAIL', 'bytes', 4",
              "SELECT 'fbs', 'FILE_EXISTS', 'PASS', '', 5", "SELECT 'fbs', 'ENCODING', 'PASS', 'utf-8', 5", "SELECT 'fbs', 'LOAD', 'FAIL', 'no rows', 5"]
    return sql(_union(parts), *RAWS)


def check_sql(check: str) -> str:
    return sql(_union(_check(n, check) for n in RAW_CTE), *RAWS)


def summary_sql() -> str:
    return sql(f"""
      SELECT coalesce(dataset, 'ALL') AS dataset, count(*) FILTER (WHERE status = 'PASS') AS passed,
             count(*) FILTER (WHERE status = 'FAIL') AS failed,
             count(*) FILTER (WHERE status = 'WARN') AS warnings,
             count(*) FILTER (WHERE status = 'FAIL') = 0 AS is_valid
      FROM {SUITE} GROUP BY ROLLUP (dataset)""", *RAWS)


FILES = ["lineitem", "part", "supplier", "nation", "region", "orders", "customer"]


def files_sql(with_md5: bool, sf_dir: str = "/root/testdata/sf0.01") -> str:
    paths = ", ".join(f"'{sf_dir}/{t}.parquet'" for t in FILES)
    md5 = ", md5(content) AS md5" if with_md5 else ""
    return (f"SELECT filename AS path, size AS bytes, CASE WHEN size / (1024.0 * 1024.0) >= 0.1 "
            f"THEN 'PASS' ELSE 'FAIL' END AS status{md5} FROM read_blob([{paths}])")


def missing_file_sql(sf_dir: str = "/root/testdata/sf0.01") -> str:
    return files_sql(False, sf_dir) + f"""
      UNION ALL SELECT '{sf_dir}/absent_table.parquet', NULL, 'FAIL'"""


# ------------------------------------------------------------------ DQ tests

def _cte(model: str) -> str:
    return f"{model[4:]}_raw" if model.startswith("raw_") else model


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _head(test: str, model: str, col: str) -> str:
    return f"SELECT '{test}' AS test, '{model}' AS model, '{col}' AS column_name"


def not_null_sql() -> str:
    parts, needs = [], set()
    for model, cols in dq_suite.NOT_NULL.items():
        needs.add(_cte(model))
        for c in cols:
            parts.append(f"{_head('not_null', model, c)}, CAST(count(*) FILTER (WHERE {c} IS NULL) "
                         f"AS BIGINT) AS failures FROM {_cte(model)}")
    return sql("\nUNION ALL\n".join(parts), *sorted(needs))


def unique_sql() -> str:
    parts, needs = [], set()
    for model, cols in dq_suite.UNIQUE.items():
        needs.add(_cte(model))
        for c in cols:
            parts.append(f"{_head('unique', model, c)}, CAST(count(*) AS BIGINT) AS failures FROM "
                         f"(SELECT {c} FROM {_cte(model)} WHERE {c} IS NOT NULL GROUP BY {c} "
                         "HAVING count(*) > 1)")
    return sql("\nUNION ALL\n".join(parts), *sorted(needs))


def accepted_sql() -> str:
    parts, needs = [], set()
    for model, c, vals in dq_suite.ACCEPTED:
        needs.add(_cte(model))
        lst = ", ".join(_lit(x) for x in vals)
        parts.append(f"{_head('accepted_values', model, c)}, CAST(count(DISTINCT {c}) FILTER (WHERE {c} IS NOT "
                     f"NULL AND {c} NOT IN ({lst})) AS BIGINT) AS failures FROM {_cte(model)}")
    return sql("\nUNION ALL\n".join(parts), *sorted(needs))


def relationships_sql() -> str:
    parts, needs = [], set()
    for child, c, parent, pc in dq_suite.RELATIONSHIPS:
        needs.update({child, parent})
        parts.append(f"{_head('relationships', child, c)}, CAST(count(*) AS BIGINT) AS failures "
                     f"FROM {child} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {parent} y WHERE y.{pc} = x.{c})")
    return sql("\nUNION ALL\n".join(parts), *sorted(needs))


def freshness_sql() -> str:
    now = f"TIMESTAMP '{dq_suite.FRESHNESS_NOW}'"
    parts = []
    for t in ("production", "trade", "fbs"):
        age = f"date_diff('day', CAST(max(_loaded_at) AS DATE), CAST({now} AS DATE))"
        parts.append(f"SELECT 'raw_{t}' AS model, CAST({age} AS INTEGER) AS age_days, "
                     f"CASE WHEN {age} > 800 THEN 'error' WHEN {age} > 400 THEN 'warn' "
                     f"ELSE 'pass' END AS status FROM {t}_raw")
    return sql("\nUNION ALL\n".join(parts), *RAWS)


def planted_sql() -> dict[str, str]:
    """The singular tests over tables with bad rows put in, so that their match is not empty."""
    return {
        "DQ-S1.bad": sql("""SELECT area_name, year, des_kcal_cap_day - 2500 AS des_kcal_cap_day, flag_des
                            FROM fct_food_security WHERE des_kcal_cap_day <= 2500""", "fct_food_security"),
        "DQ-S3.bad": sql("""SELECT area_name, item_name, year, -production_tonnes AS production_tonnes,
                                   area_harvested_ha, yield_kg_ha FROM fct_production
                            WHERE item_code % 3 = 0 AND production_tonnes > 0 AND has_production""", "fct_production"),
        "J12.bad": sql("""SELECT trade_sk, item_key FROM fct_trade
                          WHERE item_key IN (SELECT item_key FROM dim_item WHERE item_code % 3 = 0)""", "fct_trade", "dim_item"),
    }


def singular_sql() -> dict[str, str]:
    comp = "prod_tonnes / nullif(area_ha, 0) * CAST(10000.0 AS DOUBLE)"
    return {
        "DQ-S1": sql("""SELECT area_name, year, des_kcal_cap_day, flag_des FROM fct_food_security
                        WHERE des_kcal_cap_day IS NOT NULL AND des_kcal_cap_day <= 0""",
                     "fct_food_security"),
        "DQ-S2": sql("""SELECT area_name, item_name, year, import_dependency_ratio_pct,
                               export_qty_tonnes, import_qty_tonnes, production_tonnes_ref
                        FROM fct_trade WHERE import_dependency_ratio_pct IS NOT NULL
                          AND (import_dependency_ratio_pct < -100 OR import_dependency_ratio_pct > 200)""",
                     "fct_trade"),
        "DQ-S3": sql("""SELECT area_name, item_name, year, production_tonnes, area_harvested_ha,
                               yield_kg_ha FROM fct_production
                        WHERE (production_tonnes < 0 AND has_production)
                           OR (area_harvested_ha < 0 AND has_area) OR (yield_kg_ha < 0 AND has_yield)""",
                     "fct_production"),
        "DQ-S4": sql(f"""
          SELECT area_code, area_name, item_code, item_name, year,
                 {R('prod_tonnes', 0)} AS prod_tonnes, {R('area_ha', 0)} AS area_ha,
                 {R('yield_hg_ha_reported', 1)} AS yield_reported_hg_ha,
                 {R('yield_hg_ha_computed', 1)} AS yield_computed_hg_ha,
                 {R('yield_deviation_pct', 2)} AS deviation_pct
          FROM (SELECT *, {comp} AS yield_hg_ha_computed,
                       abs((yield_hg_ha_reported - {comp}) / nullif(yield_hg_ha_reported, 0)) * 100
                         AS yield_deviation_pct
                FROM yield_sums
                WHERE prod_tonnes IS NOT NULL AND prod_tonnes > 0 AND area_ha IS NOT NULL
                  AND area_ha > 0 AND yield_hg_ha_reported IS NOT NULL)
          WHERE yield_deviation_pct > 5.0 ORDER BY yield_deviation_pct DESC""", "yield_sums"),
    }


def all_check_sql() -> dict[str, str]:
    out = {qid: check_sql(name) for qid, name in CHECK_IDS.items()}
    out.update({"B01": files_sql(False), "B11": files_sql(True), "B12": summary_sql(),
                "B13": suite_sql(), "B13.files": file_suite_sql(), "B13.missing": lacking_sql(), "B01.missing": missing_file_sql(), "DQ-NN": not_null_sql(), "DQ-UQ": unique_sql(),
                "DQ-AV": accepted_sql(), "DQ-RL": relationships_sql(), "DQ-FR": freshness_sql()})
    out.update(singular_sql())
    out.update(planted_sql())
    return out
