"""Staging models (M01-M03): one narrow `select` per raw table, no shuffle.

Each casts and renames the raw columns, normalises the flag, and adds the
flag label / score, boolean flags, area type, element category and
unit-standardised value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.areas import area_type, is_country
from ..functions.core import flag_normalise, flag_when, in_period, map_values, surrogate_key
from ..functions.flags import (flag_label, flag_quality_score, is_estimated, is_high_quality,
                               is_mirror_trade, is_missing)

KEYS = ["area_code", "item_code", "element_code", "year"]


def _renamed(raw: DataFrame, with_cpc: bool) -> list:
    c = F.col
    cols = [
        c("Area_Code").cast("bigint").alias("area_code"),
        c("Item_Code").cast("bigint").alias("item_code"),
        c("Element_Code").cast("bigint").alias("element_code"),
        c("Year").cast("bigint").alias("year"),
        c("Area").cast("string").alias("area_name"),
        c("Area_Code_M49").try_cast("string").alias("area_code_m49"),
        c("Item").cast("string").alias("item_name"),
    ]
    if with_cpc:
        cols.append(c("Item_Code_CPC").cast("string").alias("item_code_cpc"))
    cols += [
        c("Element").cast("string").alias("element_name"),
        c("Unit").cast("string").alias("unit_original"),
        c("Value").cast("double").alias("value_original"),
        flag_normalise("Flag").alias("flag_code"),
        c("_loaded_at").cast("timestamp").alias("_raw_loaded_at"),
        c("_source_file").cast("string").alias("_source_file"),
        F.current_timestamp().alias("_stg_updated_at"),
    ]
    return cols


def _common(cfg: Config) -> dict:
    return {
        "flag_label": flag_label("flag_code"),
        "flag_quality_score": flag_quality_score("flag_code"),
        "is_high_quality": is_high_quality("flag_code"),
        "is_missing": is_missing("flag_code"),
    }


def stage_production(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Staged production, raw grain."""
    r = raw.select(*_renamed(raw, with_cpc=True))
    code, value, unit = F.col("element_code"), F.col("value_original"), F.col("unit_original")
    derived = dict(_common(cfg))
    derived["is_estimated"] = is_estimated("flag_code")
    derived.update({
        "area_type": area_type("area_code"),
        "is_country": is_country("area_code", cfg),
        "element_category": map_values(code, {cfg.el_area_harvested: "area_harvested",
                                              cfg.el_yield: "yield",
                                              cfg.el_production: "production"}, "other"),
        "value_standardized": F.when(code == cfg.el_yield, value / F.lit(10.0)).otherwise(value),
        "unit_standardized": (F.when(code == cfg.el_area_harvested, F.lit("ha"))
                              .when(code == cfg.el_yield, F.lit("kg/ha"))
                              .when(code == cfg.el_production, F.lit("tonnes"))
                              .otherwise(unit)),
        "is_in_project_period": in_period("year", cfg.year_start, cfg.year_end),
    })
    return r.select(surrogate_key(*KEYS).alias("production_sk"), "*",
                    *[v.alias(k) for k, v in derived.items()])


def stage_trade(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Staged trade, raw grain; values keep their units."""
    r = raw.select(*_renamed(raw, with_cpc=True))
    code, value, unit = F.col("element_code"), F.col("value_original"), F.col("unit_original")
    qty = [cfg.el_export_qty, cfg.el_import_qty]
    val = [cfg.el_export_val, cfg.el_import_val]
    derived = dict(_common(cfg))
    derived.update({
        "is_mirror_trade": is_mirror_trade("flag_code"),
        "area_type": area_type("area_code"),
        "is_country": is_country("area_code", cfg),
        "element_category": map_values(code, {cfg.el_export_qty: "export_quantity",
                                              cfg.el_export_val: "export_value",
                                              cfg.el_import_qty: "import_quantity",
                                              cfg.el_import_val: "import_value"}, "other"),
        "trade_direction": (F.when(code.isin(cfg.el_export_qty, cfg.el_export_val), F.lit("Export"))
                            .when(code.isin(cfg.el_import_qty, cfg.el_import_val), F.lit("Import"))
                            .otherwise(F.lit("Other"))),
        "measurement_type": (F.when(code.isin(*qty), F.lit("Quantity"))
                             .when(code.isin(*val), F.lit("Value")).otherwise(F.lit("Other"))),
        "unit_standardized": (F.when(code.isin(*qty), F.lit("tonnes"))
                              .when(code.isin(*val), F.lit("1000_usd_nominal")).otherwise(unit)),
        "value_standardized": value,
        "is_in_project_period": in_period("year", cfg.year_start, cfg.year_end),
    })
    return r.select(surrogate_key(*KEYS).alias("trade_sk"), "*",
                    *[v.alias(k) for k, v in derived.items()])


def stage_fbs(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Staged food balance, raw grain; 1000 t quantities become tonnes."""
    r = raw.select(*_renamed(raw, with_cpc=False))
    code, value, unit = F.col("element_code"), F.col("value_original"), F.col("unit_original")
    thousand_t = [cfg.el_fbs_production, cfg.el_fbs_import_qty, cfg.el_fbs_export_qty,
                  cfg.el_fbs_supply_qty]
    derived = dict(_common(cfg))
    derived.update({
        "area_type": area_type("area_code"),
        "is_country": is_country("area_code", cfg),
        "element_category": map_values(code, {
            cfg.el_fbs_production: "production",
            cfg.el_fbs_import_qty: "import_quantity",
            cfg.el_fbs_export_qty: "export_quantity",
            cfg.el_fbs_supply_qty: "domestic_supply",
            cfg.el_fbs_food_qty: "food_quantity",
            cfg.el_fbs_kcal: "dietary_energy_supply",
            cfg.el_fbs_protein: "protein_supply",
            cfg.el_fbs_fat: "fat_supply"}, "other"),
        "is_dietary_energy_supply": flag_when(code == cfg.el_fbs_kcal),
        "is_grand_total": flag_when(F.col("item_code") == cfg.fbs_grand_total_item),
        "value_standardized": F.when(code.isin(*thousand_t), value * F.lit(1000.0)).otherwise(value),
        "unit_standardized": (F.when(code.isin(*thousand_t), F.lit("tonnes"))
                              .when(code == cfg.el_fbs_kcal, F.lit("kcal/capita/day"))
                              .when(code.isin(cfg.el_fbs_protein, cfg.el_fbs_fat), F.lit("g/capita/day"))
                              .when(code == cfg.el_fbs_food_qty, F.lit("kg/capita/yr"))
                              .otherwise(unit)),
        "is_in_project_period": in_period("year", cfg.year_start_fbs, cfg.year_end),
    })
    return r.select(surrogate_key(*KEYS).alias("fbs_sk"), "*",
                    *[v.alias(k) for k, v in derived.items()])
