"""Scalar expressions (D/E series) on hand-built edge rows, including the dialect traps."""

import math

from pyspark.sql import functions as F

from cropflow.functions import areas, core, flags, kpi


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_flag_label_and_score(spark):
    rows = [("",), ("A",), ("B",), ("M",), ("Z",), (None,)]
    assert one(spark, flags.flag_label("f"), rows, "f string") == [
        "Official", "Aggregate", "Break in Series", "Missing", "Unknown", "Unknown"]
    # 'B' has a label but no score; unknown and NULL score NULL
    assert one(spark, flags.flag_quality_score("f"), rows, "f string") == [5, 4, None, 0, None, None]


def test_flag_booleans_never_null(spark):
    rows = [("",), ("E",), ("R",), ("M",), (None,)]
    assert one(spark, flags.is_high_quality("f"), rows, "f string") == [True, False, False, False, False]
    assert one(spark, flags.is_estimated("f"), rows, "f string") == [False, True, False, False, False]
    assert one(spark, flags.is_mirror_trade("f"), rows, "f string") == [False, False, True, False, False]
    assert one(spark, flags.is_missing("f"), rows, "f string") == [False, False, False, True, False]


def test_flag_normalise_trims_all_whitespace(spark):
    rows = [(" A ",), ("\tA\t",), (None,), ("",)]
    assert one(spark, core.flag_normalise("f"), rows, "f string") == ["A", "A", "", ""]


def test_area_type_and_country_cutoff(spark):
    rows = [(1,), (998,), (999,), (1000,), (4999,), (5000,), (None,)]
    assert one(spark, areas.area_type("a"), rows, "a long") == [
        "Country", "Country", "Country", "Sub-Regional Group", "Sub-Regional Group",
        "Global/Major Region", "Sub-Regional Group"]
    # is_country is `< 999`: area 999 is a Country by type but not is_country
    assert one(spark, areas.is_country("a"), rows, "a long") == [
        True, True, False, False, False, False, False]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    import hashlib
    rows = [(4, 15, None)]
    got = one(spark, core.surrogate_key("a", "b", "c"), rows, "a long, b long, c long")[0]
    want = hashlib.md5(b"4-15-_dbt_utils_surrogate_key_null_").hexdigest()
    assert got == want


def test_safe_divide_and_least_keep_null(spark):
    rows = [(1.0, 0.0), (None, 2.0), (500.0, 1.0), (3.0, 2.0)]
    assert one(spark, core.safe_divide("a", "b"), rows, "a double, b double") == [None, None, 500.0, 1.5]
    # Spark's least skips NULL; the guarded form keeps it NULL
    assert one(spark, core.least_nn("a", 200), rows, "a double, b double") == [1.0, None, 200.0, 3.0]


def test_import_dependency_edges(spark):
    schema = "imp double, prod double, exp double"
    rows = [(10.0, None, 0.0),       # production missing counts as 0 (as coded)
            (10.0, 0.0, 10.0),       # zero denominator -> NULL
            (10.0, 100.0, 200.0),    # negative ratio, no lower cap
            (1000.0, 0.0, 995.0),    # 1000 / 5 -> capped at 200
            (None, None, None)]
    got = one(spark, kpi.import_dependency_pct("imp", "prod", "exp"), rows, schema)
    assert got[0] == 100.0 and got[1] is None and got[2] == -11.11 and got[3] == 200.0
    assert got[4] is None
    strict = one(spark, kpi.import_dependency_pct("imp", "prod", "exp", strict=True), rows, schema)
    assert strict[0] is None


def test_energy_classes_and_integer_gaps(spark):
    rows = [(None,), (1799.9,), (1800.0,), (2099.5,), (2100.0,), (2499.5,), (2999.5,), (3000.0,)]
    cat = one(spark, kpi.des_category("d"), rows, "d double")
    assert cat == ["No Data", "Severely Inadequate", "Inadequate", "Inadequate",
                   "Borderline Adequate", "Borderline Adequate", "Adequate", "Abundant"]
    order = one(spark, kpi.des_category_order("d"), rows, "d double")
    # integer BETWEEN bands leave fractional gaps NULL (as coded)
    assert order == [0, 1, 2, None, 3, None, None, 5]
    secure = one(spark, kpi.is_food_secure("d"), rows, "d double")
    assert secure[0] is None and secure[1] is False and secure[4] is True


def test_idr_category_gaps(spark):
    rows = [(None,), (-5.0,), (0.0,), (24.5,), (25.0,), (74.0,), (200.0,)]
    assert one(spark, kpi.idr_category("r"), rows, "r double") == [
        "No Data", "Major Exporter", "Self-Sufficient", None, "Modest Import Dependency",
        "High Import Dependency", "Critical Import Dependency"]


def test_round_is_half_up_on_decimal_text(spark):
    # Spark rounds the shortest decimal text of the double
    rows = [(1.005,), (0.285,), (2.5,)]
    assert one(spark, F.round("x", 2), rows, "x double") == [1.01, 0.29, 2.5]


def test_cagr_negative_base_is_null(spark):
    rows = [(200.0, 100.0), (100.0, -50.0), (100.0, 0.0), (None, 10.0)]
    got = one(spark, kpi.cagr_pct("x", "b"), rows, "x double, b double")
    assert math.isclose(got[0], 7.18) and got[1] is None and got[2] is None and got[3] is None


def test_mean_of_present_scores(spark):
    rows = [(5, None, 3), (None, None, None), (0, 0, 0)]
    got = one(spark, core.mean_of_present("a", "b", "c"), rows, "a long, b long, c long")
    assert got == [4.0, None, 0.0]


def test_weighted_yield_factor(spark):
    rows = [(1000.0, 10.0), (5.0, 0.0)]
    assert one(spark, kpi.weighted_yield("t", "h"), rows, "t double, h double") == [1000.0, None]
