"""Data-quality tests (DQ-*). A test passes when its failure set is empty.

Generic tests return one summary row per test (test, model, column,
failures); the singular tests return their failing rows, as the reference's
SQL tests do. Every test is an aggregate or filter over the model, so it
scales with the model and never gathers a group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import orphan_keys

RESULT = "test string, model string, column_name string, failures bigint"


def _result(test: str, model: str, column: str, failures) -> DataFrame:
    return failures.select(F.lit(test).alias("test"), F.lit(model).alias("model"),
                           F.lit(column).alias("column_name"),
                           F.col("failures").cast("bigint").alias("failures"))


def not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """DQ-NN."""
    return _result("not_null", model, column,
                   df.agg(F.count_if(F.col(column).isNull()).alias("failures")))


def not_null_many(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """DQ-NN for several columns of one model in a single aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit("not_null").alias("test"), F.lit(model).alias("model"),
                              F.lit(c).alias("column_name"),
                              F.col(f"_n{i}").cast("bigint").alias("failures"))
                     for i, c in enumerate(columns)])
    return counts.select(F.inline(rows))


def _bad_values(df: DataFrame, tests: list[tuple[str, list]]) -> DataFrame:
    """Distinct (test number, value) pairs outside their lists; only bad values leave the map side."""
    pairs = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*vals),
                    F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")))
             for i, (c, vals) in enumerate(tests)]
    found = df.select(F.explode(F.filter(F.array(*pairs), lambda x: x.isNotNull())).alias("bad"))
    return found.select("bad.i", "bad.v").distinct()


def accepted_values_many(df: DataFrame, model: str, tests: list[tuple[str, list]]) -> DataFrame:
    """DQ-AV for several (column, values) of one model: distinct values outside each list."""
    counts = _bad_values(df, tests).agg(*[F.count_if(F.col("i") == i).alias(f"_a{i}") for i in range(len(tests))])
    rows = F.array(*[F.struct(F.lit("accepted_values").alias("test"), F.lit(model).alias("model"),
                              F.lit(c).alias("column_name"),
                              F.col(f"_a{i}").cast("bigint").alias("failures"))
                     for i, (c, _) in enumerate(tests)])
    return counts.select(F.inline(rows))


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """DQ-UQ: non-NULL values that occur more than once (count of such values).

    Fingerprints of eight bytes are counted first; only the values whose fingerprint occurs
    more than once are compared in full, so a key that is unique shuffles no key. They are dealt
    anew before they are counted: the map that counts them does not fill up in the task that holds
    the maps of the model itself."""
    keys = df.where(F.col(column).isNotNull()).select(F.col(column).alias("__k"), F.xxhash64(column).alias("__h"))
    met = keys.select("__h").hint("rebalance").groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
    dup = keys.join(met, "__h", "left_semi").groupBy("__k").count().where(F.col("count") > 1)
    return _result("unique", model, column, dup.agg(F.count(F.lit(1)).alias("failures")))


def accepted_values(df: DataFrame, model: str, column: str, values: list) -> DataFrame:
    """DQ-AV: distinct non-NULL values outside the list."""
    return accepted_values_many(df, model, [(column, values)])


def relationships(child: DataFrame, model: str, column: str, parent: DataFrame,
                  parent_column: str) -> DataFrame:
    """DQ-RL: non-NULL child keys without a parent row."""
    lost = orphan_keys(child, column, parent, parent_column)
    return _result("relationships", model, column, lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures")))


def freshness(df: DataFrame, model: str, ts_col: str, now: str,
              warn_days: int = 400, error_days: int = 800) -> DataFrame:
    """DQ-FR: age in days of max(ts_col) at `now` -> pass / warn / error."""
    age = F.datediff(F.to_date(F.lit(now)), F.to_date(F.max(ts_col)))
    return df.agg(F.lit(model).alias("model"), age.alias("age_days"),
                  F.when(age > error_days, "error").when(age > warn_days, "warn")
                  .otherwise("pass").alias("status"))


# ------------------------------------------------------------ singular tests

def des_positive(fct_food_security: DataFrame) -> DataFrame:
    """DQ-S1: energy supply <= 0."""
    d = F.col("des_kcal_cap_day")
    return fct_food_security.where(d.isNotNull() & (d <= 0)).select(
        "area_name", "year", "des_kcal_cap_day", "flag_des")


def dependency_bounds(fct_trade: DataFrame) -> DataFrame:
    """DQ-S2: dependency % outside [-100, 200]."""
    r = F.col("import_dependency_ratio_pct")
    return fct_trade.where(r.isNotNull() & ((r < -100) | (r > 200))).select(
        "area_name", "item_name", "year", "import_dependency_ratio_pct", "export_qty_tonnes",
        "import_qty_tonnes", "production_tonnes_ref")


def production_non_negative(fct_production: DataFrame) -> DataFrame:
    """DQ-S3: negative production / area / yield where present."""
    c = F.col
    return fct_production.where(
        ((c("production_tonnes") < 0) & c("has_production"))
        | ((c("area_harvested_ha") < 0) & c("has_area"))
        | ((c("yield_kg_ha") < 0) & c("has_yield"))).select(
        "area_name", "item_name", "year", "production_tonnes", "area_harvested_ha", "yield_kg_ha")


def yield_consistency(sums: DataFrame, tolerance_pct: float = 5.0) -> DataFrame:
    """DQ-S4: reported vs computed yield (hg/ha) deviating by more than the tolerance.

    `sums` is the G04 pivot (prod_tonnes, area_ha, yield_hg_ha_reported).
    """
    c = F.col
    s = sums.where(c("prod_tonnes").isNotNull() & (c("prod_tonnes") > 0)
                   & c("area_ha").isNotNull() & (c("area_ha") > 0)
                   & c("yield_hg_ha_reported").isNotNull())
    computed = F.try_divide(c("prod_tonnes"), c("area_ha")) * F.lit(10000.0)
    dev = F.abs(F.try_divide(c("yield_hg_ha_reported") - computed,
                             F.nullif(c("yield_hg_ha_reported"), F.lit(0)))) * 100
    s = s.select("*", computed.alias("yield_hg_ha_computed"), dev.alias("yield_deviation_pct"))
    return (s.where(c("yield_deviation_pct") > tolerance_pct)
            .orderBy(c("yield_deviation_pct").desc())
            .select("area_code", "area_name", "item_code", "item_name", "year",
                    F.round("prod_tonnes", 0).alias("prod_tonnes"),
                    F.round("area_ha", 0).alias("area_ha"),
                    F.round("yield_hg_ha_reported", 1).alias("yield_reported_hg_ha"),
                    F.round("yield_hg_ha_computed", 1).alias("yield_computed_hg_ha"),
                    F.round("yield_deviation_pct", 2).alias("deviation_pct")))
