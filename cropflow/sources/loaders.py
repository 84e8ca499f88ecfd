"""Analysis loaders (A18-A21): fixed projections of the reporting layer.

Item filters use `isin` on a column, never SQL text splicing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRENDS_COLS = ["item_code", "item_name", "commodity_group", "year", "decade", "period_label",
               "total_production_tonnes", "total_production_million_tonnes",
               "total_area_harvested_ha", "avg_yield_kg_ha_weighted", "country_count_with_data",
               "yoy_production_growth_pct", "cagr_10y_pct", "notable_event", "is_notable_event_year"]

TRADE_COLS = ["area_code", "area_name", "item_code", "item_name", "year", "fao_region",
              "income_group", "commodity_group", "export_qty_tonnes", "import_qty_tonnes",
              "net_trade_qty_tonnes", "export_val_1000usd", "import_val_1000usd",
              "net_trade_val_1000usd", "import_dependency_ratio_pct", "trade_coverage_ratio_pct",
              "idr_category", "is_net_exporter"]

FOOD_COLS = ["area_code", "area_name", "year", "fao_region", "income_group", "geographic_region",
             "development_status", "income_group_order", "decade", "period_label",
             "des_kcal_cap_day", "des_adequacy_ratio", "des_adequacy_pct", "des_category",
             "des_category_order", "is_food_secure", "des_yoy_change_kcal", "des_yoy_change_pct",
             "protein_g_cap_day", "fat_g_cap_day", "pct_kcal_from_protein", "pct_kcal_from_fat",
             "pct_kcal_from_carbs", "quality_score_des", "notable_event", "is_notable_event_year"]


def load_global_production_trends(rpt_trends: DataFrame) -> DataFrame:
    """A18."""
    return rpt_trends.select(*TRENDS_COLS).orderBy("item_code", "year")


def load_country_production(fct_production: DataFrame, dim_area: DataFrame,
                            item_codes: list[int] | None = None, year_start: int = 1991,
                            year_end: int = 2022) -> DataFrame:
    """Fact LEFT JOIN dim_area on the surrogate key, filtered."""
    p = fct_production.where(F.col("is_strategic_commodity") & F.col("has_production")
                             & F.col("year").between(year_start, year_end))
    if item_codes:
        p = p.where(F.col("item_code").isin(*item_codes))
    a = dim_area.select("area_key", "fao_region", "income_group", "geographic_region",
                        "development_status")
    j = p.join(a, "area_key", "left")
    return (j.select("area_code", "area_name", "item_code", "item_name", "year", "fao_region",
                     "income_group", "geographic_region", "development_status",
                     "production_tonnes", "production_million_tonnes", "area_harvested_ha",
                     "yield_kg_ha", "quality_score_avg", "is_strategic_commodity")
            .orderBy("item_code", "year", F.col("production_tonnes").desc()))


def load_trade_data(rpt_trade_balance: DataFrame, item_codes: list[int] | None = None) -> DataFrame:
    """A20."""
    t = rpt_trade_balance
    if item_codes:
        t = t.where(F.col("item_code").isin(*item_codes))
    return t.select(*TRADE_COLS).orderBy("item_code", "year", "area_code")


def load_food_security_data(rpt_dashboard: DataFrame) -> DataFrame:
    """A21."""
    return rpt_dashboard.select(*FOOD_COLS).orderBy("area_code", "year")
