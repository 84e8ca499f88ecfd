"""Oracle SQL per query id (DuckDB)."""

from __future__ import annotations

from cropflow.plans.catalog import C_FBS_YEAR, C_ITEM, C_YEAR, PROJECTIONS
from cropflow.sources.loaders import FOOD_COLS, TRADE_COLS, TRENDS_COLS

from .ctes import R, sql

STAMPS = ("_raw_loaded_at", "_stg_updated_at", "_dim_updated_at", "_fact_updated_at")


def model(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)


MODEL_SQL = {
    "M01": model("stg_production"),
    "M02": model("stg_trade"),
    "M03": model("stg_fbs"),
    "M04": model("int_production"),
    "M05": model("int_trade"),
    "M06": model("int_food_security"),
    "M07": model("dim_area"),
    "M08": model("dim_item"),
    "M11": model("fct_production"),
    "M12": model("fct_trade"),
    "M13": model("fct_food_security"),
    "M14": model("rpt_country_production_ranking"),
    "M15": model("rpt_global_production_trends"),
    "M16": model("rpt_trade_balance"),
    "M17": model("rpt_food_security_dashboard"),
}


def cols(names) -> str:
    return ", ".join(names)


#: Stored models, and whether they have a year.
_STORED = {"dim_area": False, "dim_item": False, "fct_production": True, "fct_trade": True, "fct_food_security": True,
           "rpt_country_production_ranking": True, "rpt_global_production_trends": True, "rpt_trade_balance": True,
           "rpt_food_security_dashboard": True}

# One line per document; Latin-1 text has one byte per character. What is left of a text's characters after the
# well-formed UTF-8 sequences among its Latin-1 bytes are the invalid bytes.
_LINES = r"""WITH lines AS (
  SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g'), '[^\x{00}-\x{FF}]', '?', 'g') AS t FROM documents),
bad AS (
  SELECT CAST(sum(length(regexp_replace(t, '[\x{00}-\x{7F}]'
      || '|[\x{C2}-\x{DF}][\x{80}-\x{BF}]|\x{E0}[\x{A0}-\x{BF}][\x{80}-\x{BF}]'
      || '|[\x{E1}-\x{EC}\x{EE}\x{EF}][\x{80}-\x{BF}]{2}|\x{ED}[\x{80}-\x{9F}][\x{80}-\x{BF}]'
      || '|\x{F0}[\x{90}-\x{BF}][\x{80}-\x{BF}]{2}|[\x{F1}-\x{F3}][\x{80}-\x{BF}]{3}|\x{F4}[\x{80}-\x{8F}][\x{80}-\x{BF}]{2}',
      '', 'g'))) AS BIGINT) AS n FROM lines)
"""
_ENCODINGS = _LINES + """SELECT 'utf-8' AS dataset, false AS has_bom, CAST(0 AS BIGINT) AS invalid_bytes, 'utf-8' AS encoding
UNION ALL SELECT 'utf-8 with mark', true, 0, 'utf-8'
UNION ALL SELECT 'latin-1', false, n, CASE WHEN n = 0 THEN 'utf-8' ELSE 'latin-1' END FROM bad"""
_LOADED_COPIES = _LINES + """SELECT dataset, count(*) AS rows, CAST(sum(doc_id) AS BIGINT) AS ids, CAST(sum(octet_length(encode(t))) AS BIGINT) AS text_bytes,
       CAST(sum(length(t)) AS BIGINT) AS text_characters
FROM lines, (VALUES ('utf-8'), ('utf-8 with mark'), ('latin-1')) v(dataset) GROUP BY dataset"""

_FLAG_DIST = sql(f"""
  SELECT CASE WHEN Flag = '' THEN 'Official (blank)' ELSE Flag END AS flag,
         count(*) AS row_count,
         {R('count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER ()', 2)} AS pct
  FROM production_raw GROUP BY Flag
  ORDER BY row_count DESC, flag ASC LIMIT 10""", "production_raw")

_TOP_PRODUCERS = sql(f"""
  SELECT Area, Area_Code, {R('Value / CAST(1000000.0 AS DOUBLE)', 2)} AS production_million_tonnes
  FROM production_raw
  WHERE Item_Code = {C_ITEM} AND Element_Code = 5510 AND Year = {C_YEAR} AND Area_Code < 1000
    AND Value IS NOT NULL
  ORDER BY Value DESC, Area_Code ASC LIMIT 5""", "production_raw")

_WORLD_KCAL = sql(f"""
  SELECT Area, {R('Value', 0)} AS kcal_per_capita_per_day FROM fbs_raw
  WHERE Area IN ('World', 'Global') AND Item_Code = 2901 AND Element LIKE '%kcal%'
    AND Year = {C_FBS_YEAR}
  ORDER BY Area, Element_Code LIMIT 3""", "fbs_raw")

_ELEMENT_COUNTS = sql("""
  SELECT Element, Element_Code, count(*) AS row_count FROM trade_raw
  GROUP BY Element, Element_Code ORDER BY row_count DESC, Element_Code""", "trade_raw")

_TRENDS_LOADER = sql(f"SELECT {cols(TRENDS_COLS)} FROM rpt_global_production_trends "
                     "ORDER BY item_code, year", "rpt_global_production_trends")

_COUNTRY_LOADER = sql("""
  SELECT p.area_code, p.area_name, p.item_code, p.item_name, p.year, a.fao_region,
         a.income_group, a.geographic_region, a.development_status, p.production_tonnes,
         p.production_million_tonnes, p.area_harvested_ha, p.yield_kg_ha, p.quality_score_avg,
         p.is_strategic_commodity
  FROM fct_production p LEFT JOIN dim_area a ON p.area_key = a.area_key
  WHERE p.is_strategic_commodity AND p.has_production AND p.year BETWEEN 1991 AND 2022
  ORDER BY p.item_code, p.year, p.production_tonnes DESC""", "fct_production", "dim_area")


def _count(raw: str) -> str:
    return sql(f"SELECT count(*) AS row_count FROM {raw}", raw)


def _years(raw: str) -> str:
    return sql(f"SELECT min(Year) AS min_year, max(Year) AS max_year FROM {raw}", raw)


DERIVED_SQL = {
    "A01.dirty": sql("""
      SELECT if(Item_Code % 5 = 0, NULL, Area_Code) AS Area_Code, Area, Item_Code, Element_Code, Year,
             if(Value >= 1000 AND Area_Code % 2 = 0, NULL, Value) AS Value, Flag, Unit, CAST(NULL AS DOUBLE) AS Extra
      FROM production_raw""", "production_raw"),
    "M14.all": model("rpt_country_production_ranking_all"),
    "M15.all": model("rpt_global_production_trends_all"),
    "M01.fine": model("stg_production_fine"),
    "M04.fine": model("int_production_fine"),
    "DQ-UQ.fine": sql("""SELECT 'unique' AS test, 'stg_production' AS model, 'production_sk' AS column_name, count(*) AS failures
      FROM (SELECT production_sk FROM stg_production_fine WHERE production_sk IS NOT NULL
            GROUP BY production_sk HAVING count(*) > 1)""", "stg_production_fine"),
    "J01": model("trade_and_output"),
    "J11": _COUNTRY_LOADER,
    "J12": sql("""
      SELECT t.trade_sk, t.item_key FROM fct_trade t
      WHERE t.item_key IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM dim_item d WHERE d.item_key = t.item_key)""",
               "fct_trade", "dim_item"),
    "G01": model("int_production_p"),
    "G02": model("int_trade_p"),
    "G03": model("int_fbs_p"),
    "G04": model("yield_sums"),
    "G07": sql("""
      SELECT count(*) AS row_count, min(Year) AS min_year, max(Year) AS max_year,
             count(DISTINCT Area_Code) AS area_count
      FROM production_raw""", "production_raw"),
    "G08": _ELEMENT_COUNTS,
    "W08": _FLAG_DIST,
    "S01": _TRENDS_LOADER,
    "S02": _TOP_PRODUCERS,
    "S03": _WORLD_KCAL,
    "S04": sql("SELECT DISTINCT item_code, item_name FROM stg_production", "stg_production"),
    "S05": model("all_areas"),
    "A18": _TRENDS_LOADER,
    "A19": _COUNTRY_LOADER,
    "A20": sql(f"SELECT {cols(TRADE_COLS)} FROM rpt_trade_balance ORDER BY item_code, year, area_code",
               "rpt_trade_balance"),
    "A21": sql(f"SELECT {cols(FOOD_COLS)} FROM rpt_food_security_dashboard ORDER BY area_code, year",
               "rpt_food_security_dashboard"),
    "A11": sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS dataset, count(*) AS source_rows, count(*) AS loaded_rows, "
        f"CAST(0 AS BIGINT) AS difference, CAST(0.0 AS DOUBLE) AS diff_pct, 'PASS' AS status "
        f"FROM {t}_raw" for t in ("production", "trade", "fbs")),
        "production_raw", "trade_raw", "fbs_raw"),
    "A13": sql("SELECT * EXCLUDE (_loaded_at) FROM production_raw", "production_raw"),
    "A10": sql("SELECT * EXCLUDE (_loaded_at) FROM trade_raw", "trade_raw"),
    "J02.coverage": sql("""
  SELECT a.area_type, count(*) AS areas, count(s.area_code) AS matched,
         count(*) - count(s.area_code) AS unmatched
  FROM (SELECT DISTINCT area_code, area_type FROM (
          SELECT area_code, area_type FROM stg_production UNION ALL
          SELECT area_code, area_type FROM stg_trade UNION ALL
          SELECT area_code, area_type FROM stg_fbs)) a
  LEFT JOIN (SELECT DISTINCT area_code FROM regions_seed) s ON a.area_code = s.area_code
  GROUP BY a.area_type""", "stg_production", "stg_trade", "stg_fbs", "regions_seed"),
    "B02": _ENCODINGS,
    "A01.encodings": _LOADED_COPIES,
    "A03": sql("""SELECT 'production.csv' AS _source_file, CAST(epoch(TIMESTAMP '2024-07-01 12:00:00') AS BIGINT) AS loaded_at_seconds,
                         count(*) AS rows FROM production_raw""", "production_raw"),
    "A11.ledger": sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS source, count(*) AS ledger_rows, count(*) AS stored_rows, CAST(0 AS BIGINT) AS difference, "
        f"true AS same_content, 'PASS' AS status FROM {t}_raw" for t in ("production", "trade", "fbs")),
        "production_raw", "trade_raw", "fbs_raw"),
    "S03.any": sql("SELECT least(1000, count(*)) AS rows, least(1000, count(*)) AS rows_of_the_table FROM stg_production", "stg_production"),
    # Item code, food-balance item code and name
    "E24.pairs": """
WITH pair(item_code, fbs_item_code, fbs_item_name) AS (VALUES
  (15, 2511, 'Wheat and products'), (27, 2805, 'Rice (Milled Equivalent)'), (44, 2513, 'Barley and products'),
  (56, 2514, 'Maize and products'), (116, 2531, 'Potatoes and products'), (125, 2533, 'Sweet potatoes'),
  (135, 2532, 'Cassava and products'), (156, 2542, 'Sugar (Raw Equivalent)'), (187, 2911, 'Pulses'),
  (236, 2555, 'Soybeans'), (254, 2777, 'Palm Oil')),
p AS (SELECT p_partkey, CAST([15, 27, 44, 56, 116, 125, 135, 156, 187, 236, 254, 16, 9999][p_partkey % 13 + 1] AS BIGINT) AS item_code FROM part)
SELECT p.p_partkey, p.item_code, CAST(pair.fbs_item_code AS BIGINT) AS fbs_item_code, pair.fbs_item_name
FROM p LEFT JOIN pair USING (item_code)""",
    "A10.year": sql("""SELECT Area_Code, Item_Code, Element_Code, Year, CASE WHEN Year = 2010 THEN Value * 2 ELSE Value END AS Value, Flag
                       FROM production_raw""", "production_raw"),
    "A17": sql("\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, count(*) AS rows, {'count(*) FILTER (WHERE year = 2010)' if y else 'CAST(NULL AS BIGINT)'} AS rows_of_year FROM {m}"
        for m, y in _STORED.items()), *_STORED),
    "D04": sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS unstamped, CAST(1 AS BIGINT) AS stamps "
               "FROM production_raw", "production_raw"),
    "A14": model("regions_seed"),
    "A14.items": model("commodity_seed"),
    "A01": sql("""SELECT * EXCLUDE (_loaded_at, _source_file, Flag),
                         coalesce(Flag, '') AS Flag, 'production.csv' AS _source_file
                  FROM production_raw""", "production_raw"),
    "D33": sql("""SELECT trade_sk, area_code, item_code, year, flag_code FROM stg_trade
                  WHERE element_code IN (5610, 5910) AND year BETWEEN 1991 AND 2022
                    AND value_original IS NOT NULL AND NOT is_missing
                    AND (flag_code LIKE 'A%' OR area_code <= 10) AND trade_direction = 'Export'""",
               "stg_trade"),
    "D36": model("fct_food_security"),
    "W06.monthly": sql("SELECT item_code, period, production_10y_ago_tonnes FROM monthly_trends",
                       "monthly_trends"),
    "E16.monthly": sql("SELECT item_code, period, total_production_tonnes, production_10y_ago_tonnes, "
                       "cagr_10y_pct FROM monthly_trends", "monthly_trends"),
    "M15.monthly": model("monthly_trends"),
    "E25": sql("""SELECT s.dataset_source, s.element_code, d.element_category, d.is_primary_kpi,
                         d.measurement_type
                  FROM (SELECT DISTINCT 'production' AS dataset_source, element_code FROM stg_production
                        UNION SELECT DISTINCT 'trade', element_code FROM stg_trade
                        UNION SELECT DISTINCT 'fbs', element_code FROM stg_fbs) s
                  LEFT JOIN dim_element d
                    ON s.dataset_source = d.dataset_source AND s.element_code = d.element_code""",
               "stg_production", "stg_trade", "stg_fbs", "dim_element"),
    "C01": _count("production_raw"),
    "C02": _years("production_raw"),
    "C03": sql("SELECT count(DISTINCT Area_Code) AS country_count FROM production_raw "
               "WHERE Area_Code < 1000", "production_raw"),
    "C04": _FLAG_DIST,
    "C05": _TOP_PRODUCERS,
    "C06": sql("""
      SELECT strftime(min(_loaded_at), '%Y-%m-%d %H:%M:%S') AS first_loaded,
             strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S') AS last_loaded,
             count(DISTINCT _source_file) AS source_files
      FROM production_raw""", "production_raw"),
    "C07": _count("trade_raw"),
    "C08": _ELEMENT_COUNTS,
    "C09": sql(f"""
      SELECT Area, {R('Value / CAST(1000.0 AS DOUBLE)', 1)} AS export_value_million_usd
      FROM trade_raw
      WHERE Item_Code = {C_ITEM} AND Element = 'Export Value' AND Year = {C_YEAR}
        AND Area_Code < 1000 AND Value IS NOT NULL
      ORDER BY Value DESC, Area_Code ASC LIMIT 5""", "trade_raw"),
    "C10": _count("fbs_raw"),
    "C11": _years("fbs_raw"),
    "C12": _WORLD_KCAL,
}


def all_sql() -> dict[str, str]:
    out = dict(MODEL_SQL)
    for qid, (cte_name, names) in PROJECTIONS.items():
        out[qid] = sql(f"SELECT {cols(names)} FROM {cte_name}", cte_name)
    out.update(DERIVED_SQL)
    out["A12"] = DERIVED_SQL["A11"]  # the report read back from its CSV equals the report
    from .checks_sql import all_check_sql
    out.update(all_check_sql())
    from .stats_sql import all_stats_sql
    out.update(all_stats_sql())
    return out
