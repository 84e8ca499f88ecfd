"""KPI expressions (E-series): each is a pure `Column -> Column` function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .core import col, least_nn, map_values, nullif_zero, safe_divide

# ---------------------------------------------------------------- production


def yield_computed(tonnes, ha) -> Column:
    """round(safe_divide(t, ha) * 1000, 2) -> kg/ha."""
    return F.round(safe_divide(tonnes, ha) * F.lit(1000.0), 2)


def yield_deviation_pct(yield_kg_ha, tonnes, ha) -> Column:
    """round(abs(safe_divide(yield - t/ha*1000, nullif(yield, 0))) * 100, 2)."""
    y = col(yield_kg_ha)
    computed = safe_divide(tonnes, ha) * F.lit(1000.0)
    return F.round(F.abs(safe_divide(y - computed, nullif_zero(y))) * 100, 2)


# --------------------------------------------------------------------- trade


def _z(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def net_trade(exp, imp) -> Column:
    """coalesce(exp, 0) - coalesce(imp, 0)."""
    return _z(exp) - _z(imp)


def import_dependency_pct(imp, prod, exp, cfg: Config = DEFAULT, strict: bool = False) -> Column:
    """round(least(imp0 / nullif(prod0 + imp0 - exp0, 0) * 100, 200), 2).

    As coded, missing production counts as 0 and there is no lower cap.
    ``strict=True`` gives NULL when production is missing (the documented intent).
    """
    ratio = safe_divide(_z(imp), nullif_zero(_z(prod) + _z(imp) - _z(exp))) * 100
    out = F.round(least_nn(ratio, cfg.import_dependency_cap), 2)
    return F.when(col(prod).isNotNull(), out) if strict else out


def trade_coverage_pct(exp_val, imp_val) -> Column:
    """round(safe_divide(expval0, nullif(impval0, 0)) * 100, 2)."""
    return F.round(safe_divide(_z(exp_val), nullif_zero(_z(imp_val))) * 100, 2)


def is_net_exporter(exp, imp) -> Column:
    """coalesce(exp,0) > coalesce(imp,0)."""
    return F.coalesce(_z(exp) > _z(imp), F.lit(False))


# ------------------------------------------------------------- food security


def des_adequacy_ratio(des, cfg: Config = DEFAULT) -> Column:
    return F.round(safe_divide(des, F.lit(cfg.des_benchmark_kcal)), 3)


def des_adequacy_pct(des, cfg: Config = DEFAULT) -> Column:
    return F.round(safe_divide(des, F.lit(cfg.des_benchmark_kcal)) * 100, 1)


def des_category(des) -> Column:
    """Energy class (fixed values: 1800 / 2100 / 2500 / 3000 kcal bands and labels)."""
    d = col(des)
    return (F.when(d.isNull(), F.lit("No Data"))
            .when(d < 1800, F.lit("Severely Inadequate"))
            .when(d < 2100, F.lit("Inadequate"))
            .when(d < 2500, F.lit("Borderline Adequate"))
            .when(d < 3000, F.lit("Adequate"))
            .otherwise(F.lit("Abundant")))


def des_category_order(des) -> Column:
    """Integer BETWEEN bands as coded, so fractional gaps (2099.5) give NULL."""
    d = col(des)
    return (F.when(d.isNull(), F.lit(0))
            .when(d < 1800, F.lit(1))
            .when(d.between(1800, 2099), F.lit(2))
            .when(d.between(2100, 2499), F.lit(3))
            .when(d.between(2500, 2999), F.lit(4))
            .when(d >= 3000, F.lit(5)))


def protein_adequacy_pct(protein, cfg: Config = DEFAULT) -> Column:
    return F.round(safe_divide(protein, F.lit(cfg.protein_benchmark_g)) * 100, 1)


def _kcal_share(grams, kcal_per_g: float, des) -> Column:
    return safe_divide(col(grams) * F.lit(kcal_per_g), nullif_zero(des)) * 100


def pct_kcal_from_protein(protein, des, cfg: Config = DEFAULT) -> Column:
    return F.round(_kcal_share(protein, cfg.kcal_per_g_protein, des), 1)


def pct_kcal_from_fat(fat, des, cfg: Config = DEFAULT) -> Column:
    return F.round(_kcal_share(fat, cfg.kcal_per_g_fat, des), 1)


def pct_kcal_from_carbs(protein, fat, des, cfg: Config = DEFAULT) -> Column:
    """100 minus both unrounded shares, then rounded."""
    return F.round(F.lit(100) - _kcal_share(protein, cfg.kcal_per_g_protein, des)
                   - _kcal_share(fat, cfg.kcal_per_g_fat, des), 1)


def is_food_secure(des, cfg: Config = DEFAULT) -> Column:
    """True when des >= 2100, NULL when des is NULL."""
    return col(des) >= F.lit(cfg.des_benchmark_kcal)


# ------------------------------------------------------------------- reports


def growth_pct(x, prev) -> Column:
    """E15/E18 %: round(safe_divide(x - prev, nullif(prev, 0)) * 100, 2)."""
    return F.round(safe_divide(col(x) - col(prev), nullif_zero(prev)) * 100, 2)


def cagr_pct(x, base, periods: int = 10) -> Column:
    """round((pow(x / nullif(base, 0), 1/periods) - 1) * 100, 2); NULL for a negative ratio."""
    ratio = safe_divide(x, nullif_zero(base))
    grown = F.pow(ratio, F.lit(1.0 / periods))
    return F.round(F.when(ratio >= 0, (grown - F.lit(1.0)) * 100), 2)


def weighted_yield(sum_t, sum_ha, cfg: Config = DEFAULT) -> Column:
    """round(safe_divide(sum t, nullif(sum ha, 0)) * factor, 1)."""
    return F.round(safe_divide(sum_t, nullif_zero(sum_ha)) * F.lit(cfg.weighted_yield_factor), 1)


def idr_category(ratio) -> Column:
    """Dependency class with the integer BETWEEN gaps as coded (gaps -> NULL).

    Fixed values: bands <0, 0-24, 25-49, 50-74, >=75 and their labels.
    """
    r = col(ratio)
    return (F.when(r.isNull(), F.lit("No Data"))
            .when(r < 0, F.lit("Major Exporter"))
            .when(r.between(0, 24), F.lit("Self-Sufficient"))
            .when(r.between(25, 49), F.lit("Modest Import Dependency"))
            .when(r.between(50, 74), F.lit("High Import Dependency"))
            .when(r >= 75, F.lit("Critical Import Dependency")))


# Income group -> order.
INCOME_ORDER = {
    "High income": 4,
    "Upper middle income": 3,
    "Lower middle income": 2,
    "Low income": 1,
}


def income_group_order(c) -> Column:
    """E23."""
    return map_values(c, INCOME_ORDER, 0)


def development_status(c) -> Column:
    c = col(c)
    return (F.when(c.isin("High income", "Upper middle income"), F.lit("Developed/Emerging"))
            .when(c.isin("Lower middle income", "Low income"), F.lit("Developing/LDC"))
            .otherwise(F.lit("Not Classified")))


# Production item code -> (food-balance item code, food-balance item name).
FBS_ITEM_MAP = {
    15: (2511, "Wheat and products"),
    27: (2805, "Rice (Milled Equivalent)"),
    56: (2514, "Maize and products"),
    44: (2513, "Barley and products"),
    236: (2555, "Soybeans"),
    187: (2911, "Pulses"),
    116: (2531, "Potatoes and products"),
    125: (2533, "Sweet potatoes"),
    135: (2532, "Cassava and products"),
    254: (2777, "Palm Oil"),
    156: (2542, "Sugar (Raw Equivalent)"),
}

# Commodity group -> order (others 9).
COMMODITY_GROUP_ORDER = {
    "Cereals": 1,
    "Protein Crops": 2,
    "Roots and Tubers": 3,
    "Oil Crops": 4,
    "Sugar Crops": 5,
}


def fbs_item_code(item_code) -> Column:
    """E24."""
    return map_values(item_code, {k: v[0] for k, v in FBS_ITEM_MAP.items()}).cast("bigint")


def fbs_item_name(item_code) -> Column:
    return map_values(item_code, {k: v[1] for k, v in FBS_ITEM_MAP.items()}).cast("string")


def commodity_group_order(c) -> Column:
    return map_values(c, COMMODITY_GROUP_ORDER, 9)


def element_measurement_type(category) -> Column:
    """Volume / Ratio / Value / Per Capita / Other."""
    c = col(category)
    return (F.when(c.isin("production", "area_harvested", "export_quantity",
                          "import_quantity", "food_quantity"), F.lit("Volume"))
            .when(c == "yield", F.lit("Ratio"))
            .when(c.isin("export_value", "import_value"), F.lit("Value"))
            .when(c.isin("dietary_energy_supply", "protein_supply", "fat_supply"), F.lit("Per Capita"))
            .otherwise(F.lit("Other")))
