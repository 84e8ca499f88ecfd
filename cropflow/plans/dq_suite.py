"""The declared data tests of the models, run over a `Models` DAG."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.flags import ACCEPTED_FLAGS
from ..operators import dq
from .pipeline import Models

# Generic tests declared for the models (model -> columns / lists).
NOT_NULL = {
    "raw_production": ["Area_Code", "Area", "Item_Code", "Item", "Element_Code", "Year", "_loaded_at"],
    "raw_trade": ["Area_Code", "Area", "Item_Code", "Item", "Element_Code", "Year", "_loaded_at"],
    "raw_fbs": ["Area_Code", "Area", "Item_Code", "Item", "Element_Code", "Year", "_loaded_at"],
    "stg_production": ["production_sk", "area_code", "item_code", "element_code", "year",
                       "area_name", "item_name", "element_name", "flag_label", "is_high_quality",
                       "is_missing", "area_type", "is_country"],
    "stg_trade": ["trade_sk", "area_code", "item_code", "element_code", "year", "is_country"],
    "stg_fbs": ["fbs_sk", "area_code", "item_code", "element_code", "year", "is_country"],
    "dim_area": ["area_key", "area_code", "area_name", "is_country"],
    "dim_item": ["item_key", "item_code", "item_name", "is_strategic_commodity"],
    "dim_element": ["element_key", "element_code"],
    "dim_year": ["year_key", "year"],
    "fct_production": ["production_sk", "area_key", "item_key", "year_key", "is_strategic_commodity"],
    "fct_trade": ["trade_sk", "area_key", "item_key", "year_key"],
    "fct_food_security": ["food_security_sk", "area_key", "year_key"],
}

UNIQUE = {
    "stg_production": ["production_sk"],
    "stg_trade": ["trade_sk"],
    "stg_fbs": ["fbs_sk"],
    "dim_area": ["area_key", "area_code"],
    "dim_item": ["item_key", "item_code"],
    "dim_element": ["element_key"],
    "dim_year": ["year_key", "year"],
    "fct_production": ["production_sk"],
    "fct_trade": ["trade_sk"],
    "fct_food_security": ["food_security_sk"],
}

AREA_TYPES = ["Country", "Sub-Regional Group", "Global/Major Region"]
ACCEPTED = [
    ("raw_production", "Element_Code", [5312, 5417, 5510]),
    ("raw_production", "Element", ["Production", "Area harvested", "Yield"]),
    ("raw_production", "Unit", ["t", "ha", "hg/ha", "1000 No", "Head", "1000 Head"]),
    ("stg_production", "element_code", [5312, 5417, 5510]),
    ("stg_production", "element_name", ["Production", "Area harvested", "Yield"]),
    ("stg_production", "unit_standardized", ["tonnes", "ha", "kg/ha"]),
    ("stg_production", "flag_code", list(ACCEPTED_FLAGS)),
    ("stg_production", "area_type", AREA_TYPES),
    ("stg_production", "element_category", ["area_harvested", "yield", "production", "other"]),
    ("raw_trade", "Element_Code", [5610, 5622, 5910, 5922]),
    ("stg_trade", "element_code", [5610, 5622, 5910, 5922]),
    ("stg_trade", "flag_code", list(ACCEPTED_FLAGS)),
    ("stg_trade", "element_category", ["export_quantity", "export_value", "import_quantity",
                                       "import_value", "other"]),
    ("stg_trade", "trade_direction", ["Export", "Import", "Other"]),
    ("stg_trade", "measurement_type", ["Quantity", "Value", "Other"]),
    ("stg_fbs", "element_category", ["production", "import_quantity", "export_quantity",
                                     "domestic_supply", "food_quantity", "dietary_energy_supply",
                                     "protein_supply", "fat_supply", "other"]),
    ("dim_area", "area_type", AREA_TYPES),
    ("dim_element", "measurement_type", ["Volume", "Ratio", "Value", "Per Capita", "Other"]),
    ("fct_food_security", "des_category", ["Severely Inadequate", "Inadequate",
                                           "Borderline Adequate", "Adequate", "Abundant",
                                           "No Data"]),
]

RELATIONSHIPS = [
    ("fct_production", "area_key", "dim_area", "area_key"),
    ("fct_production", "item_key", "dim_item", "item_key"),
    ("fct_production", "year_key", "dim_year", "year_key"),
    ("fct_trade", "area_key", "dim_area", "area_key"),
    ("fct_trade", "item_key", "dim_item", "item_key"),
    ("fct_trade", "year_key", "dim_year", "year_key"),
    ("fct_food_security", "area_key", "dim_area", "area_key"),
    ("fct_food_security", "year_key", "dim_year", "year_key"),
]

FRESHNESS_NOW = "2025-01-15 00:00:00"


def model_df(m: Models, name: str) -> DataFrame:
    if name.startswith("raw_"):
        return getattr(m.inputs.raw, name[4:])
    return getattr(m, name)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_tests(m: Models) -> DataFrame:
    return _union([dq.not_null_many(model_df(m, model), model, cols)
                   for model, cols in NOT_NULL.items()])


def unique_tests(m: Models) -> DataFrame:
    return _union([dq.unique(model_df(m, model), model, c)
                   for model, cols in UNIQUE.items() for c in cols])


def accepted_values_tests(m: Models) -> DataFrame:
    by_model: dict[str, list] = {}
    for model, c, vals in ACCEPTED:
        by_model.setdefault(model, []).append((c, vals))
    return _union([dq.accepted_values_many(model_df(m, model), model, tests)
                   for model, tests in by_model.items()])


def relationship_tests(m: Models) -> DataFrame:
    return _union([dq.relationships(model_df(m, child), child, c, model_df(m, parent), pc)
                   for child, c, parent, pc in RELATIONSHIPS])


def freshness_tests(m: Models, now: str = FRESHNESS_NOW) -> DataFrame:
    return _union([dq.freshness(model_df(m, f"raw_{t}"), f"raw_{t}", "_loaded_at", now)
                   for t in ("production", "trade", "fbs")])
