"""Long -> wide models (M04-M06) and the yield-consistency pivot.

Pivots are `groupBy(keys).agg(max(when(category == m, x)))`: a fixed output
schema and one shuffle with map-side partial aggregation. Quality flags are
aggregated as order-preserving integers and decoded after it, so the whole
pivot is a hash aggregate (Spark sorts for the maximum of a string). The country and
period filters are bare comparisons on key columns, so Catalyst pushes them
below the aggregation, through the unions of the raw tables, down to the
scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import kpi
from ..functions.core import mean_of_present, present, present_count, surrogate_key

WIDE_KEYS = ["area_code", "area_name", "item_code", "item_name", "year"]
JOIN_KEYS = ["area_code", "item_code", "year"]


def _country_period(stg: DataFrame, cfg: Config, start: int) -> DataFrame:
    # Same truth table as `is_country AND is_in_project_period`, written as
    # plain predicates so they push down.
    return stg.where((F.col("area_code") < cfg.country_area_code_max)
                     & F.col("year").between(start, cfg.year_end))


def _pick(category: str, c: str, alias: str):
    return F.max(F.when(F.col("element_category") == category, F.col(c))).alias(alias)


#: Bytes of a flag that a code holds; quality flags are single letters.
FLAG_BYTES = 6


def flag_number(flag: Column) -> Column:
    """A long that orders like the flag: its bytes, then its length. A flag over FLAG_BYTES bytes
    stops the job (``any_flags=True`` pivots such flags as strings)."""
    raw = flag.cast("binary")
    code = F.conv(F.hex(F.rpad(raw, FLAG_BYTES, F.lit(b"\x00"))), 16, 10).cast("long") * 256 + F.octet_length(raw)
    too_long = F.concat(F.lit("flag too long for a pivot by code: "), flag)
    return F.when(F.octet_length(raw) <= FLAG_BYTES, code).when(flag.isNotNull(), F.raise_error(too_long).cast("long"))


def flag_of(number: Column) -> Column:
    """The flag of a `flag_number`."""
    digits = F.lpad(F.hex(F.shiftright(number, 8)), 2 * FLAG_BYTES, "0")
    return F.decode(F.substring(F.unhex(digits), F.lit(1), number.bitwiseAND(F.lit(255)).cast("int")), "utf-8")


def _pivot(s: DataFrame, keys: list[str], cells: list[tuple[str, str, str]], any_flags: bool) -> DataFrame:
    """Cells are (category, column, name); the column `flag_code` goes through its number."""
    coded = s if any_flags else s.withColumn("__flag", flag_number(F.col("flag_code")))
    flags = {} if any_flags else {name for _, c, name in cells if c == "flag_code"}
    wide = coded.groupBy(*keys).agg(*[_pick(category, "__flag" if name in flags else c, name) for category, c, name in cells])
    return wide.select(*keys, *[flag_of(F.col(name)).alias(name) if name in flags else name for _, _, name in cells])


def pivot_production_long(stg_production: DataFrame, cfg: Config = DEFAULT, any_flags: bool = False) -> DataFrame:
    """3 measures x (value, flag, score) by 5 keys."""
    s = _country_period(stg_production, cfg, cfg.year_start)
    return _pivot(s, WIDE_KEYS, [
        ("production", "value_standardized", "production_tonnes"),
        ("production", "flag_code", "flag_production"),
        ("production", "flag_quality_score", "quality_score_production"),
        ("area_harvested", "value_standardized", "area_harvested_ha"),
        ("area_harvested", "flag_code", "flag_area_harvested"),
        ("area_harvested", "flag_quality_score", "quality_score_area"),
        ("yield", "value_standardized", "yield_kg_ha"),
        ("yield", "flag_code", "flag_yield"),
        ("yield", "flag_quality_score", "quality_score_yield"),
    ], any_flags)


def pivot_production(stg_production: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Wide production by (area, item, year) with quality and yield KPIs."""
    p = pivot_production_long(stg_production, cfg)
    t, ha, y = "production_tonnes", "area_harvested_ha", "yield_kg_ha"
    out = p.select(
        surrogate_key(*JOIN_KEYS).alias("production_wide_sk"), "*",
        mean_of_present("quality_score_production", "quality_score_area",
                        "quality_score_yield").alias("quality_score_avg"),
        present(t).alias("has_production"),
        present(ha).alias("has_area"),
        present(y).alias("has_yield"),
        present_count(t, ha, y).alias("elements_complete_count"),
        kpi.yield_computed(t, ha).alias("yield_kg_ha_computed"),
        kpi.yield_deviation_pct(y, t, ha).alias("yield_deviation_pct"),
    )
    return out.where(F.col("elements_complete_count") > 0)


def production_for_idr(stg_production: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Country production (element 5510, not missing) at (area, item, year)."""
    s = _country_period(stg_production, cfg, cfg.year_start)
    return (s.where((F.col("element_code") == cfg.el_production) & ~F.col("is_missing"))
            .select(*JOIN_KEYS, F.col("value_standardized").alias("production_tonnes"),
                    F.col("flag_quality_score").alias("quality_score_production")))


def pivot_trade_long(stg_trade: DataFrame, cfg: Config = DEFAULT, any_flags: bool = False) -> DataFrame:
    """4 measures, 10 columns, 5 keys."""
    s = _country_period(stg_trade, cfg, cfg.year_start)
    return _pivot(s, WIDE_KEYS, [
        ("export_quantity", "value_standardized", "export_qty_tonnes"),
        ("export_quantity", "flag_code", "flag_export_qty"),
        ("export_quantity", "flag_quality_score", "quality_score_export_qty"),
        ("export_value", "value_standardized", "export_val_1000usd"),
        ("export_value", "flag_code", "flag_export_val"),
        ("import_quantity", "value_standardized", "import_qty_tonnes"),
        ("import_quantity", "flag_code", "flag_import_qty"),
        ("import_quantity", "flag_quality_score", "quality_score_import_qty"),
        ("import_value", "value_standardized", "import_val_1000usd"),
        ("import_value", "flag_code", "flag_import_val"),
    ], any_flags)


def trade_and_output(stg_trade: DataFrame, stg_production: DataFrame,
                          cfg: Config = DEFAULT) -> DataFrame:
    """Trade wide LEFT JOIN country production on (area, item, year).

    Both sides are hash-partitioned on the three join keys; the production
    side is unique per key, so the join never multiplies trade rows.
    """
    t = pivot_trade_long(stg_trade, cfg)
    p = production_for_idr(stg_production, cfg)
    return t.join(p, on=JOIN_KEYS, how="left").select(*t.columns, "production_tonnes",
                                                      "quality_score_production")


def pivot_trade(stg_trade: DataFrame, stg_production: DataFrame, cfg: Config = DEFAULT,
                strict_idr: bool = False) -> DataFrame:
    """Wide trade with net trade, import dependency and coverage KPIs."""
    tw = trade_and_output(stg_trade, stg_production, cfg)
    exq, imq = "export_qty_tonnes", "import_qty_tonnes"
    exv, imv = "export_val_1000usd", "import_val_1000usd"
    return tw.select(
        surrogate_key(*JOIN_KEYS).alias("trade_wide_sk"), *WIDE_KEYS,
        exq, "flag_export_qty", "quality_score_export_qty",
        exv, "flag_export_val",
        imq, "flag_import_qty", "quality_score_import_qty",
        imv, "flag_import_val",
        "production_tonnes", "quality_score_production",
        kpi.net_trade(exq, imq).alias("net_trade_qty_tonnes"),
        kpi.net_trade(exv, imv).alias("net_trade_val_1000usd"),
        kpi.import_dependency_pct(imq, "production_tonnes", exq, cfg, strict_idr)
        .alias("import_dependency_ratio_pct"),
        kpi.trade_coverage_pct(exv, imv).alias("trade_coverage_ratio_pct"),
        kpi.is_net_exporter(exq, imq).alias("is_net_exporter"),
        mean_of_present("quality_score_export_qty", "quality_score_import_qty")
        .alias("quality_score_avg"),
        present(exq).alias("has_export_data"),
        present(imq).alias("has_import_data"),
        present("production_tonnes").alias("has_production_for_idr"),
    )


def pivot_fbs_long(stg_fbs: DataFrame, cfg: Config = DEFAULT, any_flags: bool = False) -> DataFrame:
    """4 measures, 9 columns, 3 keys (grand total only)."""
    s = _country_period(stg_fbs, cfg, cfg.year_start_fbs).where(
        F.col("item_code") == cfg.fbs_grand_total_item)
    return _pivot(s, ["area_code", "area_name", "year"], [
        ("dietary_energy_supply", "value_standardized", "des_kcal_cap_day"),
        ("dietary_energy_supply", "flag_code", "flag_des"),
        ("dietary_energy_supply", "flag_quality_score", "quality_score_des"),
        ("protein_supply", "value_standardized", "protein_g_cap_day"),
        ("protein_supply", "flag_code", "flag_protein"),
        ("fat_supply", "value_standardized", "fat_g_cap_day"),
        ("fat_supply", "flag_code", "flag_fat"),
        ("food_quantity", "value_standardized", "food_qty_kg_cap_yr"),
        ("food_quantity", "flag_code", "flag_food_qty"),
    ], any_flags)


def pivot_fbs(stg_fbs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Wide food security by (area, year) with energy and macro KPIs."""
    f = pivot_fbs_long(stg_fbs, cfg)
    des, prot, fat = "des_kcal_cap_day", "protein_g_cap_day", "fat_g_cap_day"
    return f.select(
        surrogate_key("area_code", "year").alias("food_security_wide_sk"), "*",
        kpi.des_adequacy_ratio(des, cfg).alias("des_adequacy_ratio"),
        kpi.des_adequacy_pct(des, cfg).alias("des_adequacy_pct"),
        kpi.des_category(des).alias("des_category"),
        kpi.des_category_order(des).alias("des_category_order"),
        kpi.protein_adequacy_pct(prot, cfg).alias("protein_adequacy_pct"),
        kpi.pct_kcal_from_protein(prot, des, cfg).alias("pct_kcal_from_protein"),
        kpi.pct_kcal_from_fat(fat, des, cfg).alias("pct_kcal_from_fat"),
        kpi.pct_kcal_from_carbs(prot, fat, des, cfg).alias("pct_kcal_from_carbs"),
        kpi.is_food_secure(des, cfg).alias("is_food_secure"),
    )


def yield_consistency_sums(stg_production: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Conditional sums of raw values per (area, item, year)."""
    s = _country_period(stg_production, cfg, cfg.year_start).where(
        ~F.col("is_missing")
        & F.col("element_category").isin("production", "area_harvested", "yield"))

    def part(cat, alias):
        return F.sum(F.when(F.col("element_category") == cat, F.col("value_original"))).alias(alias)

    return s.groupBy(*WIDE_KEYS).agg(part("production", "prod_tonnes"),
                                     part("area_harvested", "area_ha"),
                                     part("yield", "yield_hg_ha_reported"))
