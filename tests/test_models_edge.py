"""The whole model DAG on a hand-built raw layer with the edge rows of FIXTURES.md §5."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropflow.operators import checks
from cropflow.plans.pipeline import Inputs, Models
from cropflow.sources.driver_tables import RAW_COLUMNS, RawTables

RAW_SCHEMA = T.StructType([
    T.StructField(c, T.LongType() if c in ("Area_Code", "Item_Code", "Element_Code", "Year_Code", "Year")
                  else T.DoubleType() if c == "Value"
                  else T.TimestampType() if c == "_loaded_at" else T.StringType())
    for c in RAW_COLUMNS])
TS = datetime(2024, 6, 30)
EL = {5312: ("Area harvested", "ha"), 5417: ("Yield", "hg/ha"), 5510: ("Production", "t"),
      5610: ("Export Quantity", "t"), 5910: ("Import Quantity", "t"),
      5622: ("Export Value", "1000 USD"), 5922: ("Import Value", "1000 USD"),
      664: ("Food supply (kcal/capita/day)", "kcal/capita/day"),
      674: ("Protein supply quantity (g/capita/day)", "g/capita/day"),
      684: ("Fat supply quantity (g/capita/day)", "g/capita/day")}


def row(area, name, item, iname, el, year, value, flag=""):
    e, unit = EL[el]
    return (area, None, name, item, None, iname, el, e, year, year, unit, value, flag, TS, "hand.csv")


def production_rows():
    rows = []
    # item 15: 12 years for area 1 (lag 10 reaches), with 2003 missing for area 2
    for y in range(2000, 2012):
        rows.append(row(1, "Alpha", 15, "Wheat", 5510, y, 100.0 + 10 * (y - 2000)))
        rows.append(row(1, "Alpha", 15, "Wheat", 5312, y, 10.0))
        rows.append(row(1, "Alpha", 15, "Wheat", 5417, y, (100.0 + 10 * (y - 2000)) / 10.0 * 10000))
        if y != 2003:
            rows.append(row(2, "Beta", 15, "Wheat", 5510, y, 100.0 + 10 * (y - 2000)))  # ties area 1
    rows += [
        row(999, "Boundary", 15, "Wheat", 5510, 2005, 5.0),          # Country by type, not is_country
        row(1000, "Region", 15, "Wheat", 5510, 2005, 999.0, "A"),    # aggregate, excluded
        row(3, "Gamma", 15, "Wheat", 5510, 2005, None, "M"),         # missing value
        row(3, "Gamma", 15, "Wheat", 5312, 2005, 0.0, " A "),        # zero area, padded flag
        row(4, "Delta", 15, "Wheat", 5510, 2005, 0.0, "B"),          # zero production, 'B' no score
        row(5, "Eps", 15, "Wheat", 5510, 2005, 50.0, "\tE\t"),
        row(5, "Eps (alt)", 15, "Wheat", 5510, 2006, 60.0, "Q"),      # one code, two names
        row(1, "Alpha", 27, "Rice", 5510, 1990, 10.0),               # before the period
    ]
    return rows


def trade_rows():
    return [
        row(1, "Alpha", 15, "Wheat", 5610, 2005, 30.0), row(1, "Alpha", 15, "Wheat", 5910, 2005, 20.0),
        row(1, "Alpha", 15, "Wheat", 5622, 2005, 7.0), row(1, "Alpha", 15, "Wheat", 5922, 2005, 0.0),
        row(3, "Gamma", 15, "Wheat", 5910, 2005, 40.0),               # production missing -> 0
        row(4, "Delta", 15, "Wheat", 5610, 2005, 10.0), row(4, "Delta", 15, "Wheat", 5910, 2005, 10.0),
        row(1, "Alpha", 115, "Wheat products", 5610, 2005, 3.0),      # trade-only item
    ]


def fbs_rows():
    out = []
    names = {1: "Alpha", 2: "Beta", 3: "Gamma", 4: "Delta"}
    for area, des in [(1, 2099.5), (2, 1800.0), (3, None), (4, 3000.0)]:
        flag = "M" if des is None else ""
        out.append(row(area, names[area], 2901, "Grand Total", 664, 2012, des, flag))
        out.append(row(area, names[area], 2901, "Grand Total", 674, 2012, 60.0))
        out.append(row(area, names[area], 2901, "Grand Total", 684, 2012, 50.0))
    out.append(row(1, "Alpha", 2901, "Grand Total", 664, 2013, 2200.0))
    out.append(row(1, "Alpha", 2901, "Grand Total", 664, 2009, 2000.0))  # before the food period
    return out


@pytest.fixture(scope="module")
def edge(spark):
    def df(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    regions = spark.createDataFrame(
        [(1, "Alpha", "Asia", "High income", "East"), (2, "Beta", "Asia", "Low income", "West")],
        "area_code long, area_name string, fao_region string, income_group string, geographic_region string")
    items = spark.createDataFrame([(15, "Wheat", "Cereals", "staple", True)],
                                  "item_code long, item_name string, commodity_group string, "
                                  "strategic_reason string, is_selected boolean")
    raw = RawTables(production=df(production_rows()), trade=df(trade_rows()), fbs=df(fbs_rows()))
    return Models(spark, Inputs(raw=raw, regions_seed=regions, commodity_seed=items))


def test_staging_flags_and_countries(edge):
    s = {(r.area_code, r.element_code, r.year): r for r in edge.stg_production.collect()}
    assert s[(3, 5312, 2005)].flag_code == "A" and s[(5, 5510, 2005)].flag_code == "E"
    assert s[(4, 5510, 2005)].flag_quality_score is None and s[(4, 5510, 2005)].flag_label == "Break in Series"
    assert s[(999, 5510, 2005)].area_type == "Country" and not s[(999, 5510, 2005)].is_country
    assert s[(1, 5417, 2005)].value_standardized == s[(1, 5417, 2005)].value_original / 10


def test_wide_production_edges(edge):
    w = {(r.area_code, r.area_name, r.year): r for r in edge.int_production.collect()}
    assert (999, "Boundary", 2005) not in w and (1000, "Region", 2005) not in w
    assert (1, "Alpha", 1990) not in {(k[0], k[1], k[2]) for k in w}        # out of period
    g = w[(3, "Gamma", 2005)]
    assert g.production_tonnes is None and g.area_harvested_ha == 0.0 and g.yield_kg_ha_computed is None
    assert g.quality_score_avg == 2.0                                       # mean of (0, 4)
    assert w[(5, "Eps", 2005)].production_tonnes == 50.0 and (5, "Eps (alt)", 2006) in w


def test_trade_dependency_as_coded(edge):
    t = {(r.area_code, r.item_code): r for r in edge.int_trade.collect()}
    assert t[(3, 15)].import_dependency_ratio_pct == 100.0 and not t[(3, 15)].has_production_for_idr
    assert t[(1, 15)].import_dependency_ratio_pct == round(20 / (150 + 20 - 30) * 100, 2)
    assert t[(1, 15)].trade_coverage_ratio_pct is None                      # import value 0
    assert t[(4, 15)].import_dependency_ratio_pct is None                   # 0 + 10 - 10 = 0
    ft = {(r.area_code, r.item_code): r for r in edge.fct_trade.collect()}
    assert ft[(1, 115)].item_key is None and not ft[(1, 115)].is_strategic_commodity


def test_dim_area_keeps_two_names_for_one_code(edge):
    names = sorted(r.area_name for r in edge.dim_area.where("area_code = 5").collect())
    assert names == ["Eps", "Eps (alt)"]
    from cropflow.plans import dq_suite
    uq = {(r.model, r.column_name): r.failures for r in dq_suite.unique_tests(edge).collect()}
    assert uq[("dim_area", "area_code")] == 1 and uq[("dim_area", "area_key")] == 1


def test_ranking_ties_and_running_share(edge):
    r = edge.rpt_country_production_ranking.where("item_code = 15 AND year = 2005").collect()
    by_area = {x.area_code: x for x in r}
    # areas 1 and 2 tie on 150 t: both rank 1; running share breaks the tie by area code
    assert by_area[1].global_production_rank == 1 and by_area[2].global_production_rank == 1
    assert by_area[1].cumulative_production_share_pct < by_area[2].cumulative_production_share_pct
    assert 4 not in by_area                                                 # zero tonnes filtered


def test_trends_lag_counts_rows_and_cagr(edge):
    t = {r.year: r for r in edge.rpt_global_production_trends.where("item_code = 15").collect()}
    assert t[2000].prev_year_production_tonnes is None
    assert t[2010].production_10y_ago_tonnes == t[2000].total_production_tonnes
    want = round(((t[2010].total_production_tonnes / t[2000].total_production_tonnes) ** 0.1 - 1) * 100, 2)
    assert t[2010].cagr_10y_pct == want
    assert t[2004].prev_year_production_tonnes == t[2003].total_production_tonnes  # rows, not years


def test_food_security_classes_and_dashboard(edge):
    w = {r.area_code: r for r in edge.int_food_security.where("year = 2012").collect()}
    assert w[1].des_category == "Inadequate" and w[1].des_category_order is None   # 2099.5 gap
    assert w[3].des_category == "No Data" and w[3].is_food_secure is None
    assert w[4].des_category == "Abundant" and w[2].des_category_order == 2
    f = {(r.area_code, r.year) for r in edge.fct_food_security.collect()}
    assert (3, 2012) not in f and (1, 2009) not in f
    d = {(r.area_code, r.year): r for r in edge.rpt_food_security_dashboard.collect()}
    assert d[(1, 2013)].des_yoy_change_kcal == round(2200.0 - 2099.5, 1)


def test_key_uniqueness_with_duplicates_and_null_keys(spark):
    rows = [row(1, "A", 15, "W", 5510, 2005, 1.0), row(1, "A", 15, "W", 5510, 2005, 2.0),
            row(None, "N", 15, "W", 5510, 2005, 3.0), row(None, "N", 15, "W", 5510, 2005, 4.0),
            row(1000, "R", 15, "W", 5510, 2005, -1.0, "M")]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    c = {r.check: r for r in checks.dataset_checks(df, checks.SPECS["production"]).collect()}
    assert c["PK_UNIQUENESS"].status == "FAIL" and c["PK_UNIQUENESS"].detail == "duplicates=2 rows=5"
    assert c["NEGATIVE_VALUES"].status == "FAIL"
    assert c["AREA_TYPES"].status == "PASS" and c["ROW_COUNT"].status == "FAIL"
    assert c["FLAG_DIST"].status == "PASS"
