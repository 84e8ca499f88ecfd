
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from cropflow.config import DEFAULT
from cropflow.functions.kpi import import_dependency_pct, weighted_yield
from cropflow.operators import dims, reports
from cropflow.sources import csv_ingest


def totals(spark):
    rows = [(15, "Wheat", y, 100.0 + y - 2000, 10.0) for y in range(2000, 2012) if y != 2003]
    return spark.createDataFrame(rows, "item_code bigint, item_name string, year bigint, "
                                       "total_production_tonnes double, total_area_harvested_ha double")


def test_Q06_lag_counts_rows_by_default(spark):
    r = {x.year: x for x in reports.trend_metrics(totals(spark), "year").collect()}
    assert r[2004].prev_year_production_tonnes == 102.0  # 2003 is missing: the row before
    assert r[2010].production_10y_ago_tonnes is None  # only 9 rows before 2010
    assert r[2011].production_10y_ago_tonnes == 100.0  # 10 rows back lands on 2000


def test_Q06_lag_by_period(spark):
    r = {x.year: x for x in reports.trend_metrics(totals(spark), "year", lag_by="period").collect()}
    assert r[2004].prev_year_production_tonnes is None and r[2004].yoy_production_growth_pct is None
    assert r[2005].prev_year_production_tonnes == 104.0
    assert r[2010].production_10y_ago_tonnes == 100.0
    assert r[2011].production_10y_ago_tonnes == 101.0
    assert r[2011].cagr_10y_pct == round(((111.0 / 101.0) ** 0.1 - 1) * 100, 2)


def test_Q07_one_row_per_code(spark):
    cols = "area_code bigint, area_name string, area_code_m49 string, area_type string, is_country boolean"
    prod = spark.createDataFrame([(1, "Beta", "001", "Country", True)], cols)
    trade = spark.createDataFrame([(1, "Alpha", "001", "Country", True),
                                   (2, "Gamma", "002", "Country", True)], cols)
    fbs = spark.createDataFrame([(1, "Alpha", "001", "Country", True)], cols)
    seed = spark.createDataFrame([(1, "Asia", "High income", "Asia zone 0")],
                                 "area_code bigint, fao_region string, income_group string, "
                                 "geographic_region string")
    as_coded = dims.dim_area(prod, trade, fbs, seed)
    assert sorted((r.area_code, r.area_name) for r in as_coded.collect()) == [
        (1, "Alpha"), (1, "Beta"), (2, "Gamma")]
    one = dims.dim_area(prod, trade, fbs, seed, one_row_per_code=True)
    got = {r.area_code: r for r in one.collect()}
    assert one.count() == 2 and got[1].area_name == "Alpha" and got[1].fao_region == "Asia"
    assert got[2].fao_region == "Not Classified" and one.columns == as_coded.columns


def test_Q11_commas_stripped_only_on_request(spark):
    df = spark.createDataFrame([("1,234",), ("5.5",), ("x",)], "Value string")
    ts = datetime(2024, 1, 1)
    assert [r.Value for r in csv_ingest.prepare(df, "f.csv", ts).collect()] == [None, 5.5, None]
    assert [r.Value for r in csv_ingest.prepare(df, "f.csv", ts, strip_commas=True).collect()] == [
        1234.0, 5.5, None]


def test_Q02_Q04_dependency_and_yield_factor(spark):
    df = spark.createDataFrame([(50.0, None, 0.0, 20.0, 4.0)],
                               "imp double, prod double, exp double, t double, ha double")
    r = df.select(import_dependency_pct("imp", "prod", "exp").alias("coded"),
                  import_dependency_pct("imp", "prod", "exp", strict=True).alias("strict"),
                  weighted_yield("t", "ha").alias("y10")).first()
    assert r.coded == 100.0 and r.strict is None and r.y10 == 50.0
    assert DEFAULT.weighted_yield_factor == 10.0
    t1000 = df.select(weighted_yield("t", "ha", replace(DEFAULT, weighted_yield_factor=1000.0))).first()[0]
    assert t1000 == 5000.0
