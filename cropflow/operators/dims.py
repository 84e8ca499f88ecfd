"""Dimension models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import kpi
from ..functions.core import flag_when, surrogate_key
from ..sources.seeds import element_definitions, year_spine
from .joins import lookup_join

AREA_COLS = ["area_code", "area_name", "area_code_m49", "area_type", "is_country"]


def all_areas(*staged: DataFrame) -> DataFrame:
    """UNION DISTINCT of the area attributes of the staged tables.

    One distinct after the union is enough; each branch is pre-reduced by the
    partial aggregation Spark inserts before the shuffle.
    """
    out = None
    for s in staged:
        part = s.select(*AREA_COLS)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def dim_area(stg_production: DataFrame, stg_trade: DataFrame, stg_fbs: DataFrame,
             regions_seed: DataFrame, one_row_per_code: bool = False) -> DataFrame:
    """One row per distinct area attribute set, with region and income mapping.

    As coded, a code seen with two names (or M49 forms) gives two rows, which
    fans out every join on area_code (DQ-UQ reports it). ``one_row_per_code``
    (SURVEY Q07) keeps, per code, the smallest attribute set instead: one
    more aggregation over the distinct areas, keyed by area_code.
    """
    areas = all_areas(stg_production, stg_trade, stg_fbs)
    if one_row_per_code:
        rest = [c for c in AREA_COLS if c != "area_code"]
        areas = (areas.groupBy("area_code").agg(F.min(F.struct(*rest)).alias("a"))
                 .select("area_code", *[F.col(f"a.{c}").alias(c) for c in rest])
                 .select(*AREA_COLS))
    seed = regions_seed.select("area_code", "fao_region", "income_group", "geographic_region")
    a = lookup_join(areas, seed, "area_code", "left")
    nc = F.lit("Not Classified")
    mapped = a.select(*AREA_COLS,
                      F.coalesce("fao_region", nc).alias("fao_region"),
                      F.coalesce("income_group", nc).alias("income_group"),
                      F.coalesce("geographic_region", nc).alias("geographic_region"))
    return mapped.select(
        surrogate_key("area_code").alias("area_key"), *AREA_COLS,
        "fao_region", "income_group", "geographic_region",
        kpi.income_group_order("income_group").alias("income_group_order"),
        kpi.development_status("income_group").alias("development_status"),
        F.current_timestamp().alias("_dim_updated_at"))


def seed_coverage(stg_production: DataFrame, stg_trade: DataFrame, stg_fbs: DataFrame,
                  regions_seed: DataFrame) -> DataFrame:
    """J02 coverage: distinct area codes per area type, and how many
    of them the region seed matches. The seed is an input whose codes may
    follow another scheme; unmatched codes get 'Not Classified' in dim_area."""
    areas = all_areas(stg_production, stg_trade, stg_fbs).select("area_code", "area_type").distinct()
    seed = regions_seed.select("area_code", F.lit(True).alias("in_seed")).distinct()
    hit = F.col("in_seed").isNotNull()
    return (lookup_join(areas, seed, "area_code").groupBy("area_type")
            .agg(F.count(F.lit(1)).alias("areas"), F.count_if(hit).alias("matched"),
                 F.count_if(~hit).alias("unmatched")))


def dim_item(stg_production: DataFrame, commodity_seed: DataFrame) -> DataFrame:
    """Distinct production items with commodity attributes."""
    items = stg_production.select("item_code", "item_name").distinct()
    seed = commodity_seed.select("item_code", "commodity_group", "strategic_reason", "is_selected")
    j = lookup_join(items, seed, "item_code", "left")
    c = j.select("item_code", "item_name",
                 F.coalesce("commodity_group", F.lit("Other")).alias("commodity_group"),
                 F.coalesce("strategic_reason", F.lit("")).alias("strategic_reason"),
                 F.coalesce("is_selected", F.lit(False)).alias("is_strategic_commodity"))
    return c.select(
        surrogate_key("item_code").alias("item_key"), "item_code", "item_name",
        kpi.fbs_item_code("item_code").alias("fbs_item_code"),
        kpi.fbs_item_name("item_code").alias("fbs_item_name"),
        "commodity_group",
        kpi.commodity_group_order("commodity_group").alias("commodity_group_order"),
        "strategic_reason", "is_strategic_commodity",
        F.current_timestamp().alias("_dim_updated_at"))


def dim_element(spark: SparkSession) -> DataFrame:
    """The 14 element definitions (a literal table)."""
    e = element_definitions(spark)
    return e.select(
        surrogate_key("dataset_source", "element_code").alias("element_key"), "*",
        flag_when(F.col("element_code") == 664).alias("is_primary_kpi"),
        kpi.element_measurement_type("element_category").alias("measurement_type"),
        F.current_timestamp().alias("_dim_updated_at"))


# Notable years and their events.
NOTABLE_EVENTS = {
    2008: "Global Food Price Crisis",
    2010: "Russian Heat Wave / Export Ban",
    2011: "Arab Spring / Food Price Spike",
    2020: "COVID-19 Pandemic",
    2022: "Russia-Ukraine War / Supply Disruption",
}


def dim_year(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    """The year spine 1991-2022 with decade, period and event attributes.

    Fixed values: periods 1991-2000 / 2001-2010 / 2011-2022 and decade windows
    2013-2022 / 2003-2012 with their labels.
    """
    y = F.col("year")
    event = None
    for yr, text in NOTABLE_EVENTS.items():
        event = F.when(y == yr, F.lit(text)) if event is None else event.when(y == yr, F.lit(text))
    return year_spine(spark).select(
        surrogate_key("year").alias("year_key"), "year",
        F.concat((F.floor(y / 10) * 10).cast("string"), F.lit("s")).alias("decade"),
        (F.when(y.between(1991, 2000), F.lit("1991–2000"))
         .when(y.between(2001, 2010), F.lit("2001–2010"))
         .when(y.between(2011, 2022), F.lit("2011–2022"))).alias("period_label"),
        (F.when(y.between(2013, 2022), F.lit("Last 10 Years (2013–2022)"))
         .when(y.between(2003, 2012), F.lit("Previous 10 Years (2003–2012)"))
         .otherwise(F.lit("Earlier Period"))).alias("decade_window"),
        flag_when(y.between(cfg.year_start, cfg.year_end)).alias("is_in_production_period"),
        flag_when(y.between(cfg.year_start_fbs, cfg.year_end)).alias("is_in_fbs_period"),
        event.alias("notable_event"),
        flag_when(y.isin(*NOTABLE_EVENTS)).alias("is_notable_event_year"),
        F.current_timestamp().alias("_dim_updated_at"))
