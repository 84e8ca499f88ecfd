"""Domain constants for the agricultural-statistics pipeline.

Everything here is a plain Python literal so Catalyst folds it into the
plan (ConstantFolding); nothing is read at runtime.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # --- fixed values: project periods and the country cut-off -------------
    year_start: int = 1991
    year_start_fbs: int = 2010
    year_end: int = 2022
    country_area_code_max: int = 999  # is_country is `area_code < 999` (as coded)

    # --- fixed values: element codes, production --------------------------
    el_area_harvested: int = 5312
    el_yield: int = 5417
    el_production: int = 5510

    # --- fixed values: element codes, trade --------------------------------
    el_export_qty: int = 5610
    el_export_val: int = 5622
    el_import_qty: int = 5910
    el_import_val: int = 5922

    # --- fixed values: element codes, food balance -------------------------
    el_fbs_production: int = 5511
    el_fbs_import_qty: int = 5611
    el_fbs_export_qty: int = 5911
    el_fbs_supply_qty: int = 5072
    el_fbs_food_qty: int = 5301
    el_fbs_kcal: int = 664
    el_fbs_protein: int = 674
    el_fbs_fat: int = 684
    fbs_grand_total_item: int = 2901

    # --- fixed values: nutrition benchmarks --------------------------------
    des_benchmark_kcal: float = 2100.0
    protein_benchmark_g: float = 50.0
    kcal_per_g_protein: float = 4.0
    kcal_per_g_fat: float = 9.0

    # --- fixed values: KPI caps and factors --------------------------------
    import_dependency_cap: float = 200.0
    weighted_yield_factor: float = 10.0  # as coded (labelled kg/ha); see README


DEFAULT = Config()

# Fixed value: the NULL placeholder of the public dbt_utils surrogate-key macro;
# it must be identical for keys to agree with the reference's warehouse keys.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
