"""Fact models (M11-M13): wide model + surrogate keys of the dimensions.

Dimension lookups are left joins on natural keys. dim_year is a fixed
32-row spine and is broadcast explicitly; dim_area and dim_item are derived
from the data, so Spark's size estimate / AQE picks the join strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import surrogate_key
from .joins import lookup_join


def _keys(df: DataFrame, dim_area: DataFrame, dim_item: DataFrame | None,
          dim_year: DataFrame) -> DataFrame:
    out = lookup_join(df, dim_area.select("area_code", "area_key"), "area_code")
    if dim_item is not None:
        out = lookup_join(out, dim_item.select("item_code", "item_key", "is_strategic_commodity"),
                          "item_code")
    return lookup_join(out, dim_year.select("year", "year_key"), "year", bounded=True)


def fact_production(wide: DataFrame, dim_area: DataFrame, dim_item: DataFrame,
                    dim_year: DataFrame) -> DataFrame:
    """M11."""
    p = _keys(wide, dim_area, dim_item, dim_year)
    r = F.round
    return p.select(
        surrogate_key("area_code", "item_code", "year").alias("production_sk"),
        "area_key", "item_key", "year_key", "area_code", "item_code", "year",
        "area_name", "item_name",
        r("production_tonnes", 2).alias("production_tonnes"),
        r("area_harvested_ha", 2).alias("area_harvested_ha"),
        r("yield_kg_ha", 2).alias("yield_kg_ha"),
        r(F.col("production_tonnes") / F.lit(1e6), 4).alias("production_million_tonnes"),
        r("yield_kg_ha_computed", 2).alias("yield_kg_ha_computed"),
        r("yield_deviation_pct", 2).alias("yield_deviation_pct"),
        "flag_production", "flag_area_harvested", "flag_yield", "quality_score_avg",
        "has_production", "has_area", "has_yield", "elements_complete_count",
        F.coalesce("is_strategic_commodity", F.lit(False)).alias("is_strategic_commodity"),
        F.current_timestamp().alias("_fact_updated_at"))


def fact_trade(wide: DataFrame, dim_area: DataFrame, dim_item: DataFrame,
               dim_year: DataFrame) -> DataFrame:
    """M12. Trade-only items find no dim_item row, so their item_key is NULL (as coded)."""
    t = _keys(wide, dim_area, dim_item, dim_year)
    r = F.round
    return t.select(
        surrogate_key("area_code", "item_code", "year").alias("trade_sk"),
        "area_key", "item_key", "year_key", "area_code", "item_code", "year",
        "area_name", "item_name",
        r("export_qty_tonnes", 2).alias("export_qty_tonnes"),
        r("import_qty_tonnes", 2).alias("import_qty_tonnes"),
        r("net_trade_qty_tonnes", 2).alias("net_trade_qty_tonnes"),
        r("export_val_1000usd", 2).alias("export_val_1000usd"),
        r("import_val_1000usd", 2).alias("import_val_1000usd"),
        r("net_trade_val_1000usd", 2).alias("net_trade_val_1000usd"),
        r("production_tonnes", 2).alias("production_tonnes_ref"),
        r("import_dependency_ratio_pct", 2).alias("import_dependency_ratio_pct"),
        r("trade_coverage_ratio_pct", 2).alias("trade_coverage_ratio_pct"),
        "is_net_exporter",
        F.coalesce("is_strategic_commodity", F.lit(False)).alias("is_strategic_commodity"),
        "has_export_data", "has_import_data", "has_production_for_idr",
        "flag_export_qty", "flag_import_qty", "quality_score_avg",
        F.current_timestamp().alias("_fact_updated_at"))


def fact_food_security(wide: DataFrame, dim_area: DataFrame, dim_year: DataFrame) -> DataFrame:
    """M13. Rows without energy supply are dropped (so 'No Data' never reaches the fact)."""
    f = _keys(wide.where(F.col("des_kcal_cap_day").isNotNull()), dim_area, None, dim_year)
    r = F.round
    return f.select(
        surrogate_key("area_code", "year").alias("food_security_sk"),
        "area_key", "year_key", "area_code", "year", "area_name",
        r("des_kcal_cap_day", 1).alias("des_kcal_cap_day"),
        r("des_adequacy_ratio", 3).alias("des_adequacy_ratio"),
        r("des_adequacy_pct", 1).alias("des_adequacy_pct"),
        "des_category", "des_category_order", "is_food_secure",
        r("protein_g_cap_day", 1).alias("protein_g_cap_day"),
        r("fat_g_cap_day", 1).alias("fat_g_cap_day"),
        r("food_qty_kg_cap_yr", 1).alias("food_qty_kg_cap_yr"),
        r("protein_adequacy_pct", 1).alias("protein_adequacy_pct"),
        r("pct_kcal_from_protein", 1).alias("pct_kcal_from_protein"),
        r("pct_kcal_from_fat", 1).alias("pct_kcal_from_fat"),
        r("pct_kcal_from_carbs", 1).alias("pct_kcal_from_carbs"),
        "flag_des", "quality_score_des",
        F.current_timestamp().alias("_fact_updated_at"))
