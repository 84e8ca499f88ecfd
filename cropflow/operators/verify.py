"""Post-load verification queries (C01-C12) over the raw tables.

Each is one aggregation or one top-k; the flag distribution's share uses a
window over the grouped rows (one row per flag), never over the raw rows.
Top-k queries add the area code as a tie-break so the k rows are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_count(raw: DataFrame) -> DataFrame:
    """C01 / C07 / C10."""
    return raw.agg(F.count(F.lit(1)).alias("row_count"))


def year_range(raw: DataFrame) -> DataFrame:
    """C02 / C11."""
    return raw.agg(F.min("Year").alias("min_year"), F.max("Year").alias("max_year"))


def country_count(raw: DataFrame, cut: int = 1000) -> DataFrame:
    """C03."""
    return raw.where(F.col("Area_Code") < cut).agg(
        F.countDistinct("Area_Code").alias("country_count"))


def flag_distribution(raw: DataFrame, k: int = 10) -> DataFrame:
    """Relabelled flag, count and percent of all rows, top k by count."""
    g = raw.groupBy("Flag").agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())  # over the grouped rows only
    return (g.select(F.when(F.col("Flag") == "", F.lit("Official (blank)"))
                     .otherwise(F.col("Flag")).alias("flag"),
                     "row_count",
                     F.round(F.col("row_count") * F.lit(100.0) / total, 2).alias("pct"))
            .orderBy(F.col("row_count").desc(), F.col("flag").asc()).limit(k))


def top_producers(raw: DataFrame, item_code: int, year: int, element_code: int = 5510,
                  k: int = 5) -> DataFrame:
    """C05."""
    return (raw.where((F.col("Item_Code") == item_code) & (F.col("Element_Code") == element_code)
                      & (F.col("Year") == year) & (F.col("Area_Code") < 1000)
                      & F.col("Value").isNotNull())
            .orderBy(F.col("Value").desc(), F.col("Area_Code").asc()).limit(k)
            .select("Area", "Area_Code",
                    F.round(F.col("Value") / F.lit(1e6), 2).alias("production_million_tonnes")))


def load_audit(raw: DataFrame) -> DataFrame:
    """first/last load instant (as text) and number of source files."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    return raw.agg(F.date_format(F.min("_loaded_at"), fmt).alias("first_loaded"),
                   F.date_format(F.max("_loaded_at"), fmt).alias("last_loaded"),
                   F.countDistinct("_source_file").alias("source_files"))


def element_counts(raw: DataFrame) -> DataFrame:
    """C08 / G08."""
    return (raw.groupBy("Element", "Element_Code").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.col("row_count").desc(), "Element_Code"))


def top_exporters(raw_trade: DataFrame, item_code: int, year: int,
                  element: str = "Export Value", k: int = 5) -> DataFrame:
    """C09."""
    return (raw_trade.where((F.col("Item_Code") == item_code) & (F.col("Element") == element)
                            & (F.col("Year") == year) & (F.col("Area_Code") < 1000)
                            & F.col("Value").isNotNull())
            .orderBy(F.col("Value").desc(), F.col("Area_Code").asc()).limit(k)
            .select("Area", F.round(F.col("Value") / F.lit(1000.0), 1)
                    .alias("export_value_million_usd")))


def world_kcal(raw_fbs: DataFrame, year: int, k: int = 3) -> DataFrame:
    """World energy supply sanity rows; ordered so the limit is deterministic."""
    return (raw_fbs.where(F.col("Area").isin("World", "Global") & (F.col("Item_Code") == 2901)
                          & F.col("Element").like("%kcal%") & (F.col("Year") == year))
            .orderBy("Area", "Element_Code").limit(k)
            .select("Area", F.round("Value", 0).alias("kcal_per_capita_per_day")))


def any_rows(df: DataFrame, k: int) -> DataFrame:
    """Some k rows, no order asked for; each task hands on k rows at most."""
    return df.limit(k)


def whole_table_stats(raw: DataFrame) -> DataFrame:
    """count(*), min, max and count(distinct) with no grouping."""
    return raw.agg(F.count(F.lit(1)).alias("row_count"), F.min("Year").alias("min_year"),
                   F.max("Year").alias("max_year"),
                   F.countDistinct("Area_Code").alias("area_count"))
