"""Reporting models.

Ranking groups hold one row per area of an (item, year): up to a bound of areas
they are plain windows, beyond it they run in two levels (`running`). Lag
windows hold one row per year of an item or an area. So no window here gathers
an unbounded group in one task, and there is no whole-table (`over ()`) window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import kpi
from ..functions.core import nullif_zero, safe_divide
from .joins import lookup_join
from .ranks import BOUND
from .running import ranked_descending


def country_production_ranking(fct_production: DataFrame, dim_area: DataFrame,
                               dim_item: DataFrame, dim_year: DataFrame, bound: int = BOUND) -> DataFrame:
    """Rank, share and running share of each country within (item, year).

    An (item, year) has a row per area at most, so the number of areas tells whether a group
    may be over `bound` rows and must run in two levels."""
    p = fct_production.where(F.col("is_strategic_commodity") & F.col("has_production")
                             & (F.col("production_tonnes") > 0)).select(
        "production_sk", "area_code", "item_code", "year", "area_name", "item_name",
        "production_tonnes", "production_million_tonnes", "area_harvested_ha", "yield_kg_ha",
        "quality_score_avg", "flag_production", "is_strategic_commodity")
    p = lookup_join(p, dim_area.select("area_code", "fao_region", "income_group",
                                       "geographic_region", "development_status"), "area_code")
    p = lookup_join(p, dim_item.select("item_code", "commodity_group", "commodity_group_order"),
                    "item_code")
    p = lookup_join(p, dim_year.select("year", "decade", "period_label", "notable_event"), "year",
                    bounded=True)
    t = F.col("production_tonnes")
    spread = dim_area.count() > bound
    by = {"spread": spread, "bound": bound}
    p = ranked_descending(p, ["item_code", "year", "fao_region"], "production_tonnes", "regional_production_rank", **by)
    # Running share: ties on tonnes are broken by area_code so the result is deterministic.
    p = ranked_descending(p, ["item_code", "year"], "production_tonnes", "global_production_rank",
                          total="__total", running="__running", tie="area_code", **by)
    total = F.col("__total")
    return p.select(
        *[c for c in p.columns if c not in ("regional_production_rank", "global_production_rank", "__total", "__running")],
        "global_production_rank", "regional_production_rank",
        F.round(safe_divide(t, total) * 100, 2).alias("global_production_share_pct"),
        F.round(safe_divide(F.col("__running"), nullif_zero(total)) * 100, 2)
        .alias("cumulative_production_share_pct"),
    ).withColumn("is_top_10_producer", F.col("global_production_rank") <= 10)


def global_totals(fct_production: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """World totals per (item, year) over strategic items with production."""
    p = fct_production.where(F.col("is_strategic_commodity") & F.col("has_production"))
    return p.groupBy("item_code", "item_name", "year").agg(
        F.sum("production_tonnes").alias("total_production_tonnes"),
        F.sum("area_harvested_ha").alias("total_area_harvested_ha"),
        F.countDistinct("area_code").alias("country_count_with_data"),
        kpi.weighted_yield(F.sum("production_tonnes"), F.sum("area_harvested_ha"), cfg)
        .alias("avg_yield_kg_ha_weighted"))


def trend_metrics(totals: DataFrame, period_col: str = "year", periods: int = 10,
                  lag_by: str = "rows") -> DataFrame:
    """W05/W06 + E15/E16: 1- and n-period lags per item, YoY growth and n-period CAGR.

    ``lag_by="rows"`` (as coded): lags count rows, so a missing period shifts
    them; item_name breaks period ties. ``lag_by="period"`` (SURVEY Q06): the
    value at exactly period - 1 and period - n (for a consecutive integer
    period such as the year), NULL when that period has no row; a RANGE
    frame on the period number, so the plan keeps the same window
    partitioning and needs no self-join. Each window partition holds one
    row per period of one item.
    """
    total = F.col("total_production_tonnes")
    if lag_by == "rows":
        w = Window.partitionBy("item_code").orderBy(period_col, "item_name")
        prev, base = F.lag(total, 1).over(w), F.lag(total, periods).over(w)
    elif lag_by == "period":
        w = Window.partitionBy("item_code").orderBy(period_col)
        prev = F.max(total).over(w.rangeBetween(-1, -1))
        base = F.max(total).over(w.rangeBetween(-periods, -periods))
    else:
        raise ValueError(f"lag_by must be 'rows' or 'period', not {lag_by!r}")
    g = totals.select("*", prev.alias("prev_year_production_tonnes"),
                      base.alias("production_10y_ago_tonnes"))
    return g.select(
        "*",
        kpi.growth_pct(total, "prev_year_production_tonnes").alias("yoy_production_growth_pct"),
        kpi.cagr_pct(total, "production_10y_ago_tonnes", periods).alias("cagr_10y_pct"),
        F.round(total / F.lit(1e6), 3).alias("total_production_million_tonnes"),
        F.round(F.col("total_area_harvested_ha") / F.lit(1e6), 3).alias("total_area_million_ha"))


def global_production_trends(fct_production: DataFrame, dim_item: DataFrame,
                             dim_year: DataFrame, cfg: Config = DEFAULT,
                             lag_by: str = "rows") -> DataFrame:
    """Totals per (item, year), 1- and 10-period lags, YoY and CAGR."""
    g = trend_metrics(global_totals(fct_production, cfg), "year", lag_by=lag_by)
    g = lookup_join(g, dim_item.select("item_code", "commodity_group", "commodity_group_order"),
                    "item_code")
    return lookup_join(g, dim_year.select("year", "decade", "period_label", "notable_event",
                                          "is_notable_event_year"), "year", bounded=True)


def monthly_trends(monthly_production: DataFrame, commodity_seed: DataFrame) -> DataFrame:
    """The M15 metrics on a monthly series: (area, item, period, production_tonnes)
    rows of country areas, restricted to strategic items, summed per (item, period)."""
    strategic = commodity_seed.where(F.col("is_selected")).select("item_code")
    p = monthly_production.join(strategic, "item_code", "left_semi")
    totals = p.groupBy("item_code", "item_name", "period").agg(
        F.sum("production_tonnes").alias("total_production_tonnes"),
        F.lit(None).cast("double").alias("total_area_harvested_ha"),
        F.countDistinct("area_code").alias("country_count_with_data"))
    return trend_metrics(totals, "period").drop("total_area_harvested_ha", "total_area_million_ha")


def trade_balance(fct_trade: DataFrame, dim_area: DataFrame, dim_item: DataFrame,
                  dim_year: DataFrame) -> DataFrame:
    """Strategic trade rows with names, attributes and the dependency class.

    The reference also joins dim_area on area_key without using it; that join
    is left out (area_key is md5(area_code), so it adds nothing while
    area_key is unique, which DQ-UQ on dim_area checks).
    """
    t = fct_trade.where(F.col("is_strategic_commodity"))
    a = dim_area.select("area_code", "area_name", "fao_region", "income_group",
                        "geographic_region", "development_status")
    i = dim_item.select("item_key", F.col("item_name").alias("dim_item_name"), "commodity_group")
    y = dim_year.select("year_key", "decade", "period_label", "notable_event")
    j = lookup_join(t.drop("area_name", "item_name"), i, "item_key")
    j = lookup_join(j, y, "year_key", bounded=True)
    j = lookup_join(j, a, "area_code")
    return j.select(
        "trade_sk", "area_code", "item_code", "year",
        "area_name", "fao_region", "income_group", "geographic_region", "development_status",
        F.col("dim_item_name").alias("item_name"), "commodity_group",
        "decade", "period_label", "notable_event",
        "export_qty_tonnes", "import_qty_tonnes", "net_trade_qty_tonnes",
        "export_val_1000usd", "import_val_1000usd", "net_trade_val_1000usd",
        "import_dependency_ratio_pct", "trade_coverage_ratio_pct", "production_tonnes_ref",
        kpi.idr_category("import_dependency_ratio_pct").alias("idr_category"),
        "is_net_exporter", "has_import_data", "has_export_data", "quality_score_avg")


def food_security_dashboard(fct_food_security: DataFrame, dim_area: DataFrame,
                            dim_year: DataFrame) -> DataFrame:
    """Food security per (area, year) with YoY change; names from the dim."""
    w = Window.partitionBy("area_code").orderBy("year")
    des = F.col("des_kcal_cap_day")
    f = fct_food_security.select("*", F.lag(des, 1).over(w).alias("prev_year_des"))
    a = dim_area.select("area_code", F.col("area_name").alias("dim_area_name"), "fao_region",
                        "income_group", "geographic_region", "development_status",
                        "income_group_order")
    y = dim_year.select("year_key", "decade", "period_label", "notable_event",
                        "is_notable_event_year")
    j = lookup_join(lookup_join(f, a, "area_code"), y, "year_key", bounded=True)
    return j.select(
        "food_security_sk", "area_code", "year",
        F.col("dim_area_name").alias("area_name"), "fao_region", "income_group",
        "geographic_region", "development_status", "income_group_order",
        "decade", "period_label", "notable_event", "is_notable_event_year",
        "des_kcal_cap_day", "des_adequacy_ratio", "des_adequacy_pct", "des_category",
        "des_category_order", "is_food_secure",
        F.round(des - F.col("prev_year_des"), 1).alias("des_yoy_change_kcal"),
        kpi.growth_pct(des, "prev_year_des").alias("des_yoy_change_pct"),
        "protein_g_cap_day", "fat_g_cap_day", "food_qty_kg_cap_yr", "protein_adequacy_pct",
        "pct_kcal_from_protein", "pct_kcal_from_fat", "pct_kcal_from_carbs",
        "flag_des", "quality_score_des")
