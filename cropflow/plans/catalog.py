"""Registry of runnable queries: id -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the adapter) so its work grows
with them. Audit timestamp columns (`current_timestamp()` stamps and load
instants) are dropped from query outputs so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, dims, dq, joins, pivots, stats, verify
from . import dq_suite
from ..session import shared_path
from ..sources import encoding, ledger, loaders, versions
from .pipeline import Models, driver_models, stored_raw

TIMESTAMP_COLS = {"_raw_loaded_at", "_stg_updated_at", "_dim_updated_at", "_fact_updated_at"}

Query = Callable[[SparkSession, str], DataFrame]


def without_stamps(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in TIMESTAMP_COLS])


def model_query(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_stamps(getattr(driver_models(spark, sf_dir), attr))
    run.__name__ = f"q_{attr}"
    return run


def derived_query(fn: Callable[[Models], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_stamps(fn(driver_models(spark, sf_dir)))
    run.__name__ = getattr(fn, "__name__", "q")
    return run


MODEL_QUERIES: dict[str, Query] = {
    "M01": model_query("stg_production"),
    "M02": model_query("stg_trade"),
    "M03": model_query("stg_fbs"),
    "M04": model_query("int_production"),
    "M05": model_query("int_trade"),
    "M06": model_query("int_food_security"),
    "M07": model_query("dim_area"),
    "M08": model_query("dim_item"),
    "M11": model_query("fct_production"),
    "M12": model_query("fct_trade"),
    "M13": model_query("fct_food_security"),
    "M14": model_query("rpt_country_production_ranking"),
    "M15": model_query("rpt_global_production_trends"),
    "M16": model_query("rpt_trade_balance"),
    "M17": model_query("rpt_food_security_dashboard"),
}


# Inventory ids that are one expression, join, window or aggregate inside a
# model: id -> (model, columns shown). The computation is the model's own.
PROJECTIONS: dict[str, tuple[str, list[str]]] = {
    # scalar expressions, projections, predicates
    "D01": ("stg_production", ["production_sk", "area_code", "item_code", "element_code", "year",
                               "area_name", "item_name", "element_name", "unit_original",
                               "value_original"]),
    "D02": ("stg_fbs", ["fbs_sk", "area_code_m49"]),
    "D03": ("stg_trade", ["trade_sk", "flag_code"]),
    "D05": ("stg_production", ["production_sk", "area_code", "item_code", "element_code", "year"]),
    "D06": ("stg_production", ["production_sk", "flag_code", "flag_label"]),
    "D07": ("stg_trade", ["trade_sk", "flag_code", "flag_quality_score"]),
    "D08": ("dim_area", ["area_code", "area_name", "area_type"]),
    "D09": ("stg_production", ["production_sk", "flag_code", "is_high_quality"]),
    "D10": ("stg_fbs", ["fbs_sk", "flag_code", "is_missing"]),
    "D11": ("stg_production", ["production_sk", "flag_code", "is_estimated"]),
    "D12": ("stg_trade", ["trade_sk", "flag_code", "is_mirror_trade"]),
    "D13": ("dim_area", ["area_code", "area_name", "is_country"]),
    "D14": ("stg_fbs", ["fbs_sk", "element_code", "element_category"]),
    "D15": ("stg_trade", ["trade_sk", "element_code", "trade_direction"]),
    "D16": ("stg_trade", ["trade_sk", "element_code", "measurement_type"]),
    "D17": ("stg_production", ["production_sk", "element_code", "value_standardized"]),
    "D18": ("stg_fbs", ["fbs_sk", "element_code", "value_standardized"]),
    "D19": ("stg_fbs", ["fbs_sk", "element_code", "unit_standardized"]),
    "D20": ("stg_production", ["production_sk", "year", "is_in_project_period"]),
    "D21": ("stg_fbs", ["fbs_sk", "is_dietary_energy_supply", "is_grand_total"]),
    "D22": ("int_production", ["production_wide_sk", "yield_kg_ha_computed"]),
    "D23": ("int_production", ["production_wide_sk", "yield_deviation_pct"]),
    "D24": ("int_trade", ["trade_wide_sk", "import_dependency_ratio_pct"]),
    "D25": ("fct_trade", ["trade_sk", "export_qty_tonnes", "net_trade_val_1000usd",
                          "trade_coverage_ratio_pct"]),
    "D26": ("rpt_global_production_trends", ["item_code", "year", "cagr_10y_pct"]),
    "D27": ("rpt_global_production_trends", ["item_code", "year", "decade"]),
    "D28": ("rpt_global_production_trends", ["item_code", "year", "period_label"]),
    "D29": ("rpt_global_production_trends", ["item_code", "year", "notable_event",
                                             "is_notable_event_year"]),
    "D30": ("int_production", ["production_wide_sk", "has_production", "has_area", "has_yield",
                               "elements_complete_count"]),
    "D31": ("dim_area", ["area_code", "area_name", "fao_region", "income_group",
                         "geographic_region"]),
    "D32": ("fct_production", ["production_sk", "production_million_tonnes"]),
    "D34": ("int_production", ["production_wide_sk", "elements_complete_count"]),
    "D35": ("fct_food_security", ["food_security_sk", "des_kcal_cap_day"]),
    # KPIs
    "E01": ("int_production", ["production_wide_sk", "quality_score_avg"]),
    "E02": ("int_trade", ["trade_wide_sk", "quality_score_avg"]),
    "E03": ("int_production", ["production_wide_sk", "production_tonnes", "area_harvested_ha",
                               "yield_kg_ha_computed"]),
    "E04": ("int_production", ["production_wide_sk", "yield_kg_ha", "yield_deviation_pct"]),
    "E05": ("int_trade", ["trade_wide_sk", "net_trade_qty_tonnes", "net_trade_val_1000usd"]),
    "E06": ("int_trade", ["trade_wide_sk", "import_dependency_ratio_pct", "has_production_for_idr"]),
    "E07": ("int_trade", ["trade_wide_sk", "trade_coverage_ratio_pct"]),
    "E08": ("int_trade", ["trade_wide_sk", "is_net_exporter"]),
    "E09": ("int_food_security", ["food_security_wide_sk", "des_adequacy_ratio", "des_adequacy_pct"]),
    "E10": ("int_food_security", ["food_security_wide_sk", "des_kcal_cap_day", "des_category"]),
    "E11": ("int_food_security", ["food_security_wide_sk", "des_kcal_cap_day", "des_category_order"]),
    "E12": ("int_food_security", ["food_security_wide_sk", "protein_adequacy_pct"]),
    "E13": ("int_food_security", ["food_security_wide_sk", "pct_kcal_from_protein",
                                  "pct_kcal_from_fat", "pct_kcal_from_carbs"]),
    "E14": ("int_food_security", ["food_security_wide_sk", "is_food_secure"]),
    "E15": ("rpt_global_production_trends", ["item_code", "year", "yoy_production_growth_pct"]),
    "E16": ("rpt_global_production_trends", ["item_code", "year", "production_10y_ago_tonnes",
                                             "cagr_10y_pct"]),
    "E17": ("rpt_global_production_trends", ["item_code", "year", "avg_yield_kg_ha_weighted"]),
    "E18": ("rpt_food_security_dashboard", ["food_security_sk", "des_yoy_change_kcal",
                                            "des_yoy_change_pct"]),
    "E19": ("rpt_country_production_ranking", ["production_sk", "global_production_share_pct"]),
    "E20": ("rpt_country_production_ranking", ["production_sk", "cumulative_production_share_pct"]),
    "E21": ("rpt_country_production_ranking", ["production_sk", "global_production_rank",
                                               "is_top_10_producer"]),
    "E22": ("rpt_trade_balance", ["trade_sk", "import_dependency_ratio_pct", "idr_category"]),
    "E23": ("dim_area", ["area_code", "income_group", "income_group_order", "development_status"]),
    "E24": ("dim_item", ["item_code", "fbs_item_code", "fbs_item_name", "commodity_group_order"]),
    # joins
    "J02": ("dim_area", ["area_code", "area_name", "fao_region", "income_group",
                         "geographic_region"]),
    "J03": ("dim_item", ["item_code", "commodity_group", "strategic_reason",
                         "is_strategic_commodity"]),
    "J04": ("fct_production", ["production_sk", "area_key", "item_key", "year_key",
                               "is_strategic_commodity"]),
    "J05": ("fct_trade", ["trade_sk", "area_key", "item_key", "year_key", "is_strategic_commodity"]),
    "J06": ("fct_food_security", ["food_security_sk", "area_key", "year_key"]),
    "J07": ("rpt_country_production_ranking", ["production_sk", "fao_region", "income_group",
                                               "geographic_region", "development_status",
                                               "commodity_group", "commodity_group_order",
                                               "decade", "period_label", "notable_event"]),
    "J08": ("rpt_global_production_trends", ["item_code", "year", "commodity_group",
                                             "commodity_group_order", "decade", "period_label",
                                             "notable_event", "is_notable_event_year"]),
    "J09": ("rpt_trade_balance", ["trade_sk", "area_name", "fao_region", "income_group",
                                  "geographic_region", "development_status", "item_name",
                                  "commodity_group", "decade", "period_label", "notable_event"]),
    "J10": ("rpt_food_security_dashboard", ["food_security_sk", "area_name", "fao_region",
                                            "income_group", "geographic_region",
                                            "development_status", "income_group_order", "decade",
                                            "period_label", "notable_event",
                                            "is_notable_event_year"]),
    # aggregations
    "G05": ("rpt_global_production_trends", ["item_code", "item_name", "year",
                                             "total_production_tonnes", "total_area_harvested_ha",
                                             "country_count_with_data"]),
    "G06": ("rpt_global_production_trends", ["item_code", "year", "avg_yield_kg_ha_weighted"]),
    # windows
    "W01": ("rpt_country_production_ranking", ["production_sk", "global_production_rank"]),
    "W02": ("rpt_country_production_ranking", ["production_sk", "fao_region",
                                               "regional_production_rank"]),
    "W03": ("rpt_country_production_ranking", ["production_sk", "global_production_share_pct"]),
    "W04": ("rpt_country_production_ranking", ["production_sk", "cumulative_production_share_pct"]),
    "W05": ("rpt_global_production_trends", ["item_code", "year", "prev_year_production_tonnes"]),
    "W06": ("rpt_global_production_trends", ["item_code", "year", "production_10y_ago_tonnes"]),
    "W07": ("rpt_food_security_dashboard", ["food_security_sk", "des_yoy_change_kcal"]),
}


def projection_query(attr: str, cols: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(driver_models(spark, sf_dir), attr).select(*cols)
    return run


# Verification-query parameters: an item and years present in the derived raw tables.
C_ITEM, C_YEAR, C_FBS_YEAR = 15, 2010, 2013


def _raw(attr: str):
    return lambda m: getattr(m.inputs.raw, attr)


DERIVED: dict[str, Callable[[Models], DataFrame]] = {
    "J01": lambda m: pivots.trade_and_output(m.stg_trade, m.stg_production, m.cfg),
    "J11": lambda m: loaders.load_country_production(m.fct_production, m.dim_area),
    "J12": lambda m: joins.orphans(m.fct_trade, "item_key", m.dim_item, "item_key")
    .select("trade_sk", "item_key"),
    "G01": lambda m: pivots.pivot_production_long(m.stg_production, m.cfg),
    "G02": lambda m: pivots.pivot_trade_long(m.stg_trade, m.cfg),
    "G03": lambda m: pivots.pivot_fbs_long(m.stg_fbs, m.cfg),
    "G04": lambda m: pivots.yield_consistency_sums(m.stg_production, m.cfg),
    "G07": lambda m: verify.whole_table_stats(m.inputs.raw.production),
    "G08": lambda m: verify.element_counts(m.inputs.raw.trade),
    "W08": lambda m: verify.flag_distribution(m.inputs.raw.production),
    "S01": lambda m: loaders.load_global_production_trends(m.rpt_global_production_trends),
    "S02": lambda m: verify.top_producers(m.inputs.raw.production, C_ITEM, C_YEAR),
    "S03": lambda m: verify.world_kcal(m.inputs.raw.fbs, C_FBS_YEAR),
    "S04": lambda m: m.stg_production.select("item_code", "item_name").distinct(),
    "S05": lambda m: dims.all_areas(m.stg_production, m.stg_trade, m.stg_fbs),
    "A18": lambda m: loaders.load_global_production_trends(m.rpt_global_production_trends),
    "A19": lambda m: loaders.load_country_production(m.fct_production, m.dim_area),
    "A20": lambda m: loaders.load_trade_data(m.rpt_trade_balance),
    "A21": lambda m: loaders.load_food_security_data(m.rpt_food_security_dashboard),
    "C01": lambda m: verify.row_count(m.inputs.raw.production),
    "C02": lambda m: verify.year_range(m.inputs.raw.production),
    "C03": lambda m: verify.country_count(m.inputs.raw.production),
    "C04": lambda m: verify.flag_distribution(m.inputs.raw.production),
    "C05": lambda m: verify.top_producers(m.inputs.raw.production, C_ITEM, C_YEAR),
    "C06": lambda m: verify.load_audit(m.inputs.raw.production),
    "C07": lambda m: verify.row_count(m.inputs.raw.trade),
    "C08": lambda m: verify.element_counts(m.inputs.raw.trade),
    "C09": lambda m: verify.top_exporters(m.inputs.raw.trade, C_ITEM, C_YEAR),
    "C10": lambda m: verify.row_count(m.inputs.raw.fbs),
    "C11": lambda m: verify.year_range(m.inputs.raw.fbs),
    "C12": lambda m: verify.world_kcal(m.inputs.raw.fbs, C_FBS_YEAR),
}


def _raw_tables(m: Models) -> dict[str, DataFrame]:
    r = m.inputs.raw
    return {"production": r.production, "trade": r.trade, "fbs": r.fbs}


def _suite(m: Models) -> DataFrame:
    return checks.validation_suite(_raw_tables(m))


def _check(name: str, drop: tuple[str, ...] = ()):
    """One check over the three raw tables, each with only its own aggregate; ``drop``
    leaves columns out, as a faulty download would."""
    def fn(m: Models) -> DataFrame:
        parts = [checks.one_check(df.drop(*drop), checks.SPECS[t], name) for t, df in _raw_tables(m).items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
    return fn


# Columns a faulty download may lack (B13.missing).
LACKING = ("Flag", "Element", "Year")


def _suite_lacking(m: Models) -> DataFrame:
    return checks.validation_suite({t: df.drop(*LACKING) for t, df in _raw_tables(m).items()})


# Files the raw layer is derived from (B01 / B11 inspect them).
SOURCE_FILES = ["lineitem", "part", "supplier", "nation", "region", "orders", "customer"]


def _files(with_md5: bool, also: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = [f"{sf_dir}/{t}.parquet" for t in [*SOURCE_FILES, *also]]
        return checks.file_checks(spark, paths, with_md5=with_md5)
    return run


CHECK_IDS = {"B03": "COLUMNS_PRESENT", "B04": "ROW_COUNT", "B05": "PK_UNIQUENESS",
             "B06": "YEAR_RANGE", "B07": "ELEMENTS_PRESENT", "B08": "NEGATIVE_VALUES",
             "B09": "FLAG_DIST", "B10": "AREA_TYPES"}

DERIVED["J02.coverage"] = lambda m: dims.seed_coverage(m.stg_production, m.stg_trade, m.stg_fbs,
                                                     m.inputs.regions_seed)
DERIVED.update({qid: _check(name) for qid, name in CHECK_IDS.items()})
DERIVED.update({
    "A13": lambda m: m.inputs.raw.production.drop("_loaded_at"),
    "A14": lambda m: m.inputs.regions_seed,
    "A14.items": lambda m: m.inputs.commodity_seed,
})
DERIVED.update({
    "B12": lambda m: checks.validation_summary(_suite(m)),
    "B13": _suite,
    "B13.missing": _suite_lacking,
    "DQ-NN": dq_suite.not_null_tests,
    "DQ-UQ": dq_suite.unique_tests,
    "DQ-AV": dq_suite.accepted_values_tests,
    "DQ-RL": dq_suite.relationship_tests,
    "DQ-FR": dq_suite.freshness_tests,
    "DQ-S1": lambda m: dq.des_positive(m.fct_food_security),
    "DQ-S2": lambda m: dq.dependency_bounds(m.fct_trade),
    "DQ-S3": lambda m: dq.production_non_negative(m.fct_production),
    # the same tests over tables with bad rows put in
    "DQ-S1.bad": lambda m: dq.des_positive(m.fct_food_security.withColumn(
        "des_kcal_cap_day", F.col("des_kcal_cap_day") - 2500)),
    "DQ-S3.bad": lambda m: dq.production_non_negative(m.fct_production.withColumn(
        "production_tonnes", F.when(F.expr("item_code % 3 = 0"), -F.col("production_tonnes")).otherwise(F.col("production_tonnes")))),
    "J12.bad": lambda m: joins.orphans(m.fct_trade, "item_key", m.dim_item.where("item_code % 3 <> 0"), "item_key")
    .select("trade_sk", "item_key"),
    "DQ-S4": lambda m: dq.yield_consistency(pivots.yield_consistency_sums(m.stg_production, m.cfg)),
})


# Statistics over the models: value, group and label columns are parameters.
_DASH = "rpt_food_security_dashboard"
TT_LABELS = ("Developed/Emerging", "Developing/LDC")


def _st_co(m: Models) -> DataFrame:
    return stats.correlation(m.fct_production, "area_harvested_ha", "production_tonnes",
                             ["item_code"], "area_harvested_ha", "production_tonnes")


def _st_tt(m: Models) -> DataFrame:
    return stats.ttest(getattr(m, _DASH), "des_kcal_cap_day", "development_status", *TT_LABELS)


def _st_an(m: Models):
    return stats.anova(getattr(m, _DASH), "des_kcal_cap_day", "income_group")


DERIVED.update({
    "ST-DS": lambda m: stats.descriptive_stats(m.fct_production, "production_tonnes", ["item_code"]),
    "ST-OI": lambda m: stats.iqr_outliers(m.fct_production, "yield_kg_ha", ["item_code"])[1],
    "ST-OI.rows": lambda m: stats.iqr_outliers(m.fct_production, "yield_kg_ha", ["item_code"])[0]
    .select("production_sk", "is_outlier"),
    "ST-CO": _st_co,
    "ST-CO.core": lambda m: _st_co(m).select("item_code", "n_observations", "pearson_r",
                                             "spearman_rho"),
    "ST-CI": lambda m: stats.mean_ci(m.fct_food_security, "des_kcal_cap_day", ["year"]),
    "ST-CI.core": lambda m: stats.mean_ci(m.fct_food_security, "des_kcal_cap_day", ["year"])
    .select("year", "n", "mean", "std_error"),
    "ST-TT": _st_tt,
    "ST-TT.core": lambda m: _st_tt(m).select("n1", "n2", "mean1", "mean2", "mean_difference",
                                             "std1", "std2", "levene_stat", "cohens_d",
                                             "effect_size"),
    "ST-AN": lambda m: _st_an(m)[0],
    "ST-AN.core": lambda m: _st_an(m)[0].select("n_groups", "total_n", "levene_stat",
                                                "f_statistic", "eta_squared", "effect_size"),
    "ST-AN.groups": lambda m: _st_an(m)[1],
    "ST-CH": lambda m: stats.chi_square(getattr(m, _DASH), "income_group", "des_category"),
    "ST-CH.core": lambda m: stats.chi_square(getattr(m, _DASH), "income_group", "des_category")
    .select("chi2_statistic", "degrees_of_freedom", "n_total", "min_expected_freq",
            "cells_below_5", "total_cells", "assumption_met", "cramers_v", "effect_size"),
    "ST-CH.2x2": lambda m: stats.chi_square(getattr(m, _DASH), "is_food_secure",
                                            "is_notable_event_year")
    .select("chi2_statistic", "degrees_of_freedom", "n_total", "min_expected_freq",
            "cells_below_5", "total_cells", "assumption_met", "cramers_v", "effect_size"),
    "ST-LB": lambda m: _st_co(m).select("item_code", "pearson_interpret", "pearson_p_interpret",
                                        "spearman_interpret", "spearman_p_interpret"),
    # the labels that depend on r / rho only (the p-value labels need the t tail)
    "ST-LB.core": lambda m: _st_co(m).select("item_code", "pearson_r_squared", "pearson_interpret",
                                             "spearman_interpret", "pearson_spearman_agree"),
})


def _loaded(spark: SparkSession, sf_dir: str):
    """The loaded raw tables by name, and the ledger of their loads."""
    raw = stored_raw(spark, sf_dir, driver_models(spark, sf_dir).inputs.raw)
    return {t: getattr(raw, t) for t in ("production", "trade", "fbs")}, raw.ledger


def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the ledger, counted while the raw layer was loaded, vs rows stored in it."""
    from ..sources import csv_ingest
    tables, book = _loaded(spark, sf_dir)
    loads = {r["source"]: r["rows"] for r in ledger.last_loads(spark, book).collect()}
    parts = [csv_ingest.reconcile(loads[t], df, t) for t, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _ledger_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 by rows and content: the stored raw tables, counted and hashed anew, against the ledger."""
    tables, book = _loaded(spark, sf_dir)
    return ledger.reconcile(spark, book, tables)


def _predicates(m: Models) -> DataFrame:
    """=, IN, BETWEEN, IS NOT NULL, NOT, AND/OR, LIKE and <= in one filter."""
    t = m.stg_trade
    cond = (F.col("element_code").isin(5610, 5910) & F.col("year").between(1991, 2022)
            & F.col("value_original").isNotNull() & ~F.col("is_missing")
            & (F.col("flag_code").like("A%") | (F.col("area_code") <= 10))
            & (F.col("trade_direction") == "Export"))
    return t.where(cond).select("trade_sk", "area_code", "item_code", "year", "flag_code")


def _observed_elements(m: Models) -> DataFrame:
    """E25 over the data: the classes of the elements that occur in the staged tables."""
    seen = (m.stg_production.select(F.lit("production").alias("dataset_source"), "element_code")
            .unionByName(m.stg_trade.select(F.lit("trade").alias("dataset_source"), "element_code"))
            .unionByName(m.stg_fbs.select(F.lit("fbs").alias("dataset_source"), "element_code"))
            .distinct())
    d = m.dim_element.select("dataset_source", "element_code", "element_category",
                             "is_primary_kpi", "measurement_type")
    return seen.join(F.broadcast(d), ["dataset_source", "element_code"], "left")


def _csv_download(spark: SparkSession, raw: DataFrame, kind: str) -> str:
    """A raw table written as a CSV download (original headers) in the shared folder."""
    from ..sources import csv_ingest
    from ..streaming.ingest import CSV_COLUMNS
    path = shared_path(spark, kind)
    by_clean = {csv_ingest.clean_column_name(c): c for c in CSV_COLUMNS}
    out = raw.select(*[F.col(c).alias(by_clean[c]) for c in raw.columns if c in by_clean])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw production table written as a CSV download (original
    headers, blank official flags) in the shared folder, then loaded back
    through the ingest path (encoding check, text read, name clean-up, NULL
    words, flag fill, numeric coercion, audit columns)."""
    from ..sources import csv_ingest
    raw = driver_models(spark, sf_dir).inputs.raw.production
    path = _csv_download(spark, raw, "cropflow-csv")
    loaded = csv_ingest.load_csv(spark, path, "production.csv")
    return loaded.drop("_loaded_at")


# The declared schema a dirty download is loaded to (A07-A09): Extra is missing from the
# file, Note is not declared, the last type name is unknown.
DIRTY_SCHEMA = """[{"name": "Area_Code", "type": "INTEGER"}, {"name": "Area", "type": "STRING", "mode": "REQUIRED"},
  {"name": "Item_Code", "type": "INT64"}, {"name": "Element_Code", "type": "INTEGER"}, {"name": "Year", "type": "int64"},
  {"name": "Value", "type": "FLOAT64"}, {"name": "Flag", "type": "STRING"}, {"name": "Unit", "type": "GEOGRAPHY"},
  {"name": "Extra", "type": "FLOAT"}]"""


def _csv_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A01-A09 on a dirty download: thousands separators, fractional codes, NULL words for
    blank flags, padded codes, an undeclared and a missing column."""
    from ..sources import csv_ingest
    raw = driver_models(spark, sf_dir).inputs.raw.production
    code = F.col("Area_Code").cast("string")
    dirty = raw.select(
        F.when(F.col("Item_Code") % 5 == 0, F.concat(code, F.lit(".5"))).otherwise(F.concat(F.lit(" "), code)).alias("Area Code"),
        F.col("Area"), F.col("Item_Code").alias("Item Code"), F.col("Element_Code").alias("Element Code"), F.col("Year"),
        F.when((F.col("Value") >= 1000) & (F.col("Area_Code") % 2 == 0), F.format_number("Value", 1))
        .otherwise(F.col("Value").cast("string")).alias("Value"),
        F.when(F.col("Flag") == "", F.lit("NA")).otherwise(F.concat(F.lit(" "), F.col("Flag"))).alias("Flag"),
        F.col("Unit"), F.lit("n/a").alias("Note"))
    path = shared_path(spark, "cropflow-csv")
    dirty.write.option("header", True).option("escape", '"').csv(path)
    return csv_ingest.load_csv(spark, path, "production.csv", csv_ingest.schema_from_json(DIRTY_SCHEMA))


def _encoded_copies(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The documents (id, text on one line) as CSV files in UTF-8, in UTF-8 with a byte-order mark, and in Latin-1."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", " ")
    text = F.regexp_replace(text, r"[^\x00-\xFF]", "?")  # Latin-1 holds no more
    line = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(',"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    # each task writes one file: its first line brings the header
    opens = F.expr("monotonically_increasing_id() & 8589934591 = 0")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(line.alias("line"), opens.alias("opens"))

    def copy(mark: bytes, charset: str) -> str:
        path = shared_path(spark, "cropflow-encoded")
        head = F.when(F.col("opens"), F.concat(F.lit(mark), F.lit(b"doc_id,text\n"))).otherwise(F.lit(b""))
        docs.select(F.concat(head, F.encode("line", charset)).cast("string").alias("value")).write.text(path)
        return path

    return {"utf-8": copy(b"", "UTF-8"), "utf-8 with mark": copy(encoding.MARKS["utf-8"], "UTF-8"), "latin-1": copy(b"", "ISO-8859-1")}


def _encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoding found in the bytes of the three copies."""
    parts = [encoding.encoding_report(spark, path, name) for name, path in _encoded_copies(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _load_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A01 on the three copies: what was loaded does not depend on the file's encoding."""
    from ..sources import csv_ingest
    parts = []
    for name, path in _encoded_copies(spark, sf_dir).items():
        df = csv_ingest.read_csv(spark, path, encoding.detect_encoding(spark, path))
        parts.append(df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"), F.sum(F.col("doc_id").try_cast("bigint")).alias("ids"),
                            F.sum(F.octet_length("text")).alias("text_bytes"), F.sum(F.char_length("text")).alias("text_characters")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LOAD_INSTANT = datetime(2024, 7, 1, 12, tzinfo=timezone.utc)


def _audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit columns that the CSV loader adds, counted."""
    from ..sources import csv_ingest
    raw = driver_models(spark, sf_dir).inputs.raw.production
    loaded = csv_ingest.load_csv(spark, _csv_download(spark, raw, "cropflow-csv"), "production.csv", loaded_at=LOAD_INSTANT)
    return loaded.groupBy("_source_file", F.unix_timestamp("_loaded_at").alias("loaded_at_seconds")).agg(F.count(F.lit(1)).alias("rows"))


def _file_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13 on CSV files: existence, size, encoding, load, then the checks; an absent file, one
    that is too small and one without rows stop at their first failure."""
    raw = driver_models(spark, sf_dir).inputs.raw
    paths = {t: _csv_download(spark, getattr(raw, t), "cropflow-csv") for t in ("production", "trade", "fbs")}
    runs = [(t, path, 0.0) for t, path in paths.items()]
    runs += [("production", paths["production"] + "-absent", 0.0), ("trade", paths["trade"], 1e9),
             ("fbs", _csv_download(spark, raw.fbs.limit(0), "cropflow-csv"), 0.0)]
    out = None
    for k, (t, path, least) in enumerate(runs):
        part = checks.validate_file(spark, path, checks.SPECS[t], least).withColumn("run", F.lit(k))
        out = part if out is None else out.unionByName(part)
    # the size in bytes depends on how the rows were dealt over files
    return out.withColumn("detail", F.regexp_replace("detail", "^bytes=[0-9]+$", "bytes"))


def _stored_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model written as a table (facts by year) and read back; rows in all and of one year."""
    from .pipeline import FACT_YEAR_PARTITIONS, STORED_LAYERS, materialize
    m = materialize(driver_models(spark, sf_dir), shared_path(spark, "cropflow-layer"), partition_by=FACT_YEAR_PARTITIONS)
    out = None
    for name in [n for layer in STORED_LAYERS for n in layer if n not in ("dim_element", "dim_year")]:
        df = getattr(m, name)
        of_year = F.count_if(F.col("year") == C_YEAR) if "year" in df.columns else F.lit(None).cast("long")
        part = df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"), of_year.alias("rows_of_year"))
        out = part if out is None else out.unionByName(part)
    return out


def _replace_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 by partition: the raw production table, then one year of it replaced (values doubled)."""
    raw = driver_models(spark, sf_dir).inputs.raw.production.drop("_loaded_at")
    table = shared_path(spark, "cropflow-versions")
    versions.publish(raw, table, "Year")
    before = versions.current(spark, table)
    versions.publish(before.where(F.col("Year") == C_YEAR).withColumn("Value", F.col("Value") * 2), table, "Year", replaced=[C_YEAR])
    now = versions.current(spark, table)
    return now.select("Area_Code", "Item_Code", "Element_Code", "Year", "Value", "Flag")


def _parquet_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the Parquet/snappy full-replace writer. The raw food-balance table is
    written to a path, then the raw trade table to the same path; reading back
    gives exactly the trade table (an appending writer would keep the
    food-balance rows too)."""
    from ..sources import csv_ingest
    raw = driver_models(spark, sf_dir).inputs.raw
    path = shared_path(spark, "cropflow-parquet")
    csv_ingest.write_table(raw.fbs, path)
    csv_ingest.write_table(raw.trade, path)
    return spark.read.parquet(path).drop("_loaded_at")


def _report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation report (A11) written as CSV with a header in the
    shared folder and read back with its declared types."""
    from ..sources import csv_ingest
    report = _reconcile(spark, sf_dir)
    path = shared_path(spark, "cropflow-report")
    csv_ingest.write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def _stamps(m: Models) -> DataFrame:
    """Every staged production row carries the load stamp, one instant per query."""
    ts = F.col("_stg_updated_at")
    return m.stg_production.agg(F.count(F.lit(1)).alias("rows"),
                                F.count_if(ts.isNull()).alias("unstamped"),
                                F.count_distinct(ts).alias("stamps"))


SOME_ROWS = 1_000


def _some_rows(m: Models) -> DataFrame:
    """Rows of a limit without order; which they are is open, so they are counted and looked up."""
    df = m.stg_production.select("production_sk")
    some = verify.any_rows(df, SOME_ROWS).withColumnRenamed("production_sk", "some_sk")
    met = some.join(df, F.col("some_sk") == F.col("production_sk"), "left")
    return met.agg(F.count(F.lit(1)).alias("rows"), F.count("production_sk").alias("rows_of_the_table"))


def _food_balance_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E24 over all of its pairs: each part is given an item code of the map, or one beside it."""
    from ..functions import kpi
    codes = [*sorted(kpi.FBS_ITEM_MAP), 16, 9999]
    item = F.get(F.array(*[F.lit(c).cast("long") for c in codes]), (F.col("p_partkey") % len(codes)).cast("int"))
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", item.alias("item_code"))
    return part.select("p_partkey", "item_code", kpi.fbs_item_code("item_code").alias("fbs_item_code"), kpi.fbs_item_name("item_code").alias("fbs_item_name"))


def _monthly(cols):
    """W06/E16 on months: 83 periods let the 10-period lag reach back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..operators import reports
        from ..sources import driver_tables
        m = driver_models(spark, sf_dir)
        df = reports.monthly_trends(driver_tables.monthly_production(spark, sf_dir),
                                    m.inputs.commodity_seed)
        return df.select(*cols) if cols else df
    return run


def _fine(fn: Callable[[Models], DataFrame]) -> Query:
    """A query over the fine-grained production table, whose rows grow with lineitem."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..sources import driver_tables
        from .pipeline import Inputs
        raw = driver_tables.RawTables(production=driver_tables.fine_production(spark, sf_dir), trade=None, fbs=None)
        return without_stamps(fn(Models(spark, Inputs(raw=raw, regions_seed=None, commodity_seed=None))))
    return run


def _all_items(attr: str) -> Query:
    """A strategic report with every item selected (the selection is a seed parameter)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..sources import driver_tables, seeds
        from .pipeline import Inputs
        stored = driver_models(spark, sf_dir).inputs
        seed = seeds.commodity_seed(driver_tables.read_table(spark, sf_dir, "part"), selected=None)
        inputs = Inputs(raw=stored.raw, regions_seed=stored.regions_seed, commodity_seed=seed)
        return without_stamps(getattr(Models(spark, inputs), attr))
    return run


FINE = {
    "M01.fine": lambda m: m.stg_production,
    "M04.fine": lambda m: m.int_production,
    "DQ-UQ.fine": lambda m: dq.unique(m.stg_production, "stg_production", "production_sk"),
    "ST-DS.fine": lambda m: stats.descriptive_stats(m.int_production, "production_tonnes", ["year"]),
}


def all_queries() -> dict[str, Query]:
    out = dict(MODEL_QUERIES)
    for qid, (attr, cols) in PROJECTIONS.items():
        out[qid] = projection_query(attr, cols)
    for qid, fn in DERIVED.items():
        out[qid] = derived_query(fn)
    out["A11"] = _reconcile
    out["A11.ledger"] = _ledger_check
    out["A03"] = _audit_columns
    out["E24.pairs"] = _food_balance_items
    out["S03.any"] = derived_query(_some_rows)
    out["A01.encodings"] = _load_encodings
    out["A10.year"] = _replace_year
    out["A17"] = _stored_layer
    out["B13.files"] = _file_suite
    out["A01"] = _csv_round_trip
    out["A01.dirty"] = _csv_dirty
    out["A10"] = _parquet_replace
    out["A12"] = _report_csv
    out["B02"] = _encodings
    out["D04"] = derived_query(_stamps)
    out["D33"] = derived_query(_predicates)
    out["W06.monthly"] = _monthly(["item_code", "period", "production_10y_ago_tonnes"])
    out["E16.monthly"] = _monthly(["item_code", "period", "total_production_tonnes",
                                   "production_10y_ago_tonnes", "cagr_10y_pct"])
    out["M15.monthly"] = _monthly(None)
    out["D36"] = model_query("fct_food_security")
    out["E25"] = derived_query(_observed_elements)
    out["B01"] = _files(with_md5=False)
    out["B11"] = _files(with_md5=True)
    out.update({qid: _fine(fn) for qid, fn in FINE.items()})
    out["M14.all"] = _all_items("rpt_country_production_ranking")
    out["M15.all"] = _all_items("rpt_global_production_trends")
    out["B01.missing"] = _files(with_md5=False, also=("absent_table",))
    return out
