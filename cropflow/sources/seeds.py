"""Lookup tables: the two seeds, the element literal table and the year spine.

Seeds are CSV lookups with declared types (`read_seed_csv`). For the driver
tables the same two seeds are derived from nation/region and part; their
sizes are bounded by the TPC-H spec (25 nations, 25 brands), so joins to
them broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGION_SEED_SCHEMA = T.StructType([
    T.StructField("area_code", T.LongType()),
    T.StructField("area_name", T.StringType()),
    T.StructField("fao_region", T.StringType()),
    T.StructField("income_group", T.StringType()),
    T.StructField("geographic_region", T.StringType()),
])

COMMODITY_SEED_SCHEMA = T.StructType([
    T.StructField("item_code", T.LongType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("commodity_group", T.StringType()),
    T.StructField("strategic_reason", T.StringType()),
    T.StructField("is_selected", T.BooleanType()),
])

# Income groups assigned by (nationkey // 5) for the derived seed;
# the fifth band has no income group and maps to 'Not Classified' downstream.
INCOME_BANDS = ["High income", "Upper middle income", "Lower middle income", "Low income"]
# Commodity groups assigned by (item_code - 1) % 5.
COMMODITY_GROUPS = ["Cereals", "Protein Crops", "Roots and Tubers", "Oil Crops", "Sugar Crops"]
# The commodity seed selects 11 strategic commodities; the derived seed
# selects these item codes by default. Every item still flows through every model;
# only the `is_strategic_commodity` flag and the strategic reports use the selection.
STRATEGIC_ITEMS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed file: header row, declared schema, RFC-4180 quoting."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def region_seed(nation: DataFrame, region: DataFrame) -> DataFrame:
    band = F.floor(F.col("n_nationkey") / 5).cast("int")
    income = F.element_at(F.array(*[F.lit(x) for x in INCOME_BANDS]), band + 1)
    return (nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
            .select((F.col("n_nationkey") + 1).cast("bigint").alias("area_code"),
                    F.col("n_name").alias("area_name"),
                    F.col("r_name").alias("fao_region"),
                    F.when(band < len(INCOME_BANDS), income).alias("income_group"),
                    F.concat(F.col("r_name"), F.lit(" zone "),
                             F.pmod(F.col("n_nationkey"), F.lit(3)).cast("string")).alias("geographic_region")))


def commodity_seed(part: DataFrame, selected: tuple[int, ...] | None = STRATEGIC_ITEMS) -> DataFrame:
    """The selected commodities (``None``: every item of ``part``)."""
    item = F.substr(F.col("p_brand"), F.lit(7)).try_cast("bigint")
    items = (part.select(item.alias("item_code"), F.col("p_brand").alias("item_name"))
             .where(F.lit(True) if selected is None else F.col("item_code").isin(*selected)).distinct())
    group = F.element_at(F.array(*[F.lit(g) for g in COMMODITY_GROUPS]),
                         (F.pmod(F.col("item_code") - 1, F.lit(5)) + 1).cast("int"))
    return items.select("item_code", "item_name", group.alias("commodity_group"),
                        F.concat(F.lit("Selected commodity #"), F.col("item_code").cast("string"))
                        .alias("strategic_reason"),
                        F.lit(True).alias("is_selected"))


# The 14 element definitions of the element dimension
# (dataset_source, element_code, element_name, unit_standardized, element_category, domain, description).
ELEMENT_DEFINITIONS = [
    ("production", 5312, "Area harvested", "ha", "area_harvested", "Crop",
     "Agricultural land area actually harvested (not planted)."),
    ("production", 5417, "Yield", "kg/ha", "yield", "Crop",
     "Standardized from hg/ha. Production per unit of harvested area."),
    ("production", 5510, "Production", "tonnes", "production", "Crop",
     "Total agricultural production in metric tonnes."),
    ("trade", 5610, "Export Quantity", "tonnes", "export_quantity", "Trade",
     "Total export quantity in metric tonnes."),
    ("trade", 5622, "Export Value", "1000 USD", "export_value", "Trade",
     "Total export value in thousands of US dollars (nominal)."),
    ("trade", 5910, "Import Quantity", "tonnes", "import_quantity", "Trade",
     "Total import quantity in metric tonnes."),
    ("trade", 5922, "Import Value", "1000 USD", "import_value", "Trade",
     "Total import value in thousands of US dollars (nominal)."),
    ("fbs", 664, "Food supply (kcal/capita/day)", "kcal/capita/day", "dietary_energy_supply",
     "Food Security", "Primary KPI. Total dietary energy supply per capita per day."),
    ("fbs", 674, "Protein supply quantity (g/capita/day)", "g/capita/day", "protein_supply",
     "Food Security", "Total protein supply per capita per day."),
    ("fbs", 684, "Fat supply quantity (g/capita/day)", "g/capita/day", "fat_supply",
     "Food Security", "Total fat supply per capita per day."),
    ("fbs", 5301, "Food supply quantity (kg/capita/yr)", "kg/capita/yr", "food_quantity",
     "Food Security", "Total food quantity available per capita per year."),
    ("fbs", 5511, "Production", "tonnes", "production", "Food Balance",
     "FBS production (converted from 1000t to tonnes in staging)."),
    ("fbs", 5611, "Import Quantity", "tonnes", "import_quantity", "Food Balance",
     "FBS import quantity (converted from 1000t in staging)."),
    ("fbs", 5911, "Export Quantity", "tonnes", "export_quantity", "Food Balance",
     "FBS export quantity (converted from 1000t in staging)."),
]

ELEMENT_SCHEMA = T.StructType([
    T.StructField("dataset_source", T.StringType()),
    T.StructField("element_code", T.LongType()),
    T.StructField("element_name", T.StringType()),
    T.StructField("unit_standardized", T.StringType()),
    T.StructField("element_category", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("description", T.StringType()),
])


def element_definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ELEMENT_DEFINITIONS, ELEMENT_SCHEMA)


def year_spine(spark: SparkSession, start: int = 1991, end_exclusive: int = 2023) -> DataFrame:
    """Yearly date spine, end-exclusive, reduced to the year number (32 rows by default)."""
    return spark.range(start, end_exclusive, numPartitions=1).select(F.col("id").alias("year"))
