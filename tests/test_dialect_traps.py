
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropflow.functions.core import flag_normalise, least_nn, safe_divide
from cropflow.functions.kpi import cagr_pct, weighted_yield
from cropflow.operators import checks, dims, stats
from cropflow.sources import csv_ingest, driver_tables, loaders


def one(df, c):
    return df.select(c).first()[0]


def test_T01_least_keeps_null(spark):
    df = spark.createDataFrame([(None,), (250.0,), (50.0,)], "x double")
    got = [r[0] for r in df.select(least_nn("x", 200.0)).collect()]
    assert got == [None, 200.0, 50.0]


def test_T02_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, None, 1.5]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(F.col("a") / F.col("b")).collect()  # why try_divide is used


def test_T03_round_ties_on_decimal_text(spark):
    df = spark.createDataFrame([(1.005, 0.285)], "a double, b double")
    r = df.select(F.round("a", 2), F.round("b", 2)).first()
    assert (r[0], r[1]) == (1.01, 0.29)


def test_T04_decade_text_has_no_fraction(spark):
    d = {r.year: r.decade for r in dims.dim_year(spark).collect()}
    assert d[1991] == "1990s" and d[2000] == "2000s" and d[2022] == "2020s"
    assert len(d) == 32


def test_T05_trim_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\tA \n",), (" \t",), (None,)], "f string")
    assert [r[0] for r in df.select(flag_normalise("f")).collect()] == ["A", "", ""]


def test_T06_negative_base_gives_null_not_nan(spark):
    df = spark.createDataFrame([(-50.0, 100.0), (200.0, 100.0), (0.0, 100.0)], "x double, b double")
    got = [r[0] for r in df.select(cagr_pct("x", "b")).collect()]
    assert got[0] is None and got[1] == round((2 ** 0.1 - 1) * 100, 2) and got[2] == -100.0


def test_T07_integer_over_literal_stays_double(spark):
    df = spark.createDataFrame([(15, 4)], "t bigint, ha bigint")
    out = df.select(weighted_yield("t", "ha").alias("y"))
    assert isinstance(out.schema["y"].dataType, T.DoubleType)
    assert one(out, "y") == 37.5


def test_T08_skewness_is_population_moment(spark):
    xs = [1.0, 2.0, 3.0, 10.0, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    r = stats.descriptive_figures(df, "v").first()
    a = np.array(xs)
    m = a - a.mean()
    m2, m3, m4 = (m ** 2).mean(), (m ** 3).mean(), (m ** 4).mean()
    assert r.skewness == pytest.approx(m3 / m2 ** 1.5, rel=1e-12)
    assert r.kurtosis == pytest.approx(m4 / m2 ** 2 - 3, rel=1e-12)


def test_T09_mode_is_smallest_of_ties(spark):
    df = spark.createDataFrame([(x,) for x in [2.0, 2.0, 1.0, 1.0, 3.0, None]], "v double")
    assert stats.descriptive_figures(df, "v").first().mode == 1.0


def test_T10_key_uniqueness_counts_null_keys(spark):
    from tests.test_models_edge import RAW_SCHEMA, row
    rows = [row(None, "N", 15, "W", 5510, 2005, 3.0), row(None, "N", 15, "W", 5510, 2005, 4.0),
            row(1, "A", 15, "W", 5510, 2005, 1.0)]
    c = {r.check: r for r in checks.dataset_checks(spark.createDataFrame(rows, RAW_SCHEMA),
                                                   checks.SPECS["production"]).collect()}
    assert c["PK_UNIQUENESS"].status == "FAIL" and c["PK_UNIQUENESS"].detail.startswith("duplicates=1")


def test_T11_fractional_integer_text_is_null(spark):
    df = spark.createDataFrame([("1.5", "2001", "x"), (" 7 ", "1,234", "1,234")],
                               "Year string, Item_Code string, Value string")
    rows = csv_ingest.prepare(df, "f.csv", datetime(2024, 1, 1)).collect()
    assert (rows[0].Year, rows[0].Item_Code, rows[0].Value) == (None, 2001, None)
    assert (rows[1].Year, rows[1].Item_Code, rows[1].Value) == (7, None, None)


def test_T12_ascending_sort_puts_nulls_first(spark):
    schema = T.StructType([T.StructField(c, T.LongType() if c in ("item_code", "year")
                                         else T.StringType()) for c in loaders.TRENDS_COLS])
    base = {c: None for c in loaders.TRENDS_COLS}
    rows = [dict(base, item_code=2, year=2000), dict(base, item_code=None, year=2001),
            dict(base, item_code=1, year=None), dict(base, item_code=1, year=1999)]
    df = spark.createDataFrame([tuple(r[c] for c in loaders.TRENDS_COLS) for r in rows], schema)
    got = [(r.item_code, r.year) for r in loaders.load_global_production_trends(df).collect()]
    assert got == [(None, 2001), (1, None), (1, 1999), (2, 2000)]


def test_T13_timestamp_ntz_year_ignores_session_zone(spark):
    orders = spark.createDataFrame(
        [(1, 10.0, datetime(2020, 12, 31, 23, 30)), (1, 5.0, datetime(2021, 1, 1, 0, 30))],
        T.StructType([T.StructField("o_custkey", T.LongType()),
                      T.StructField("o_totalprice", T.DoubleType()),
                      T.StructField("o_orderdate", T.TimestampNTZType())]))
    customer = spark.createDataFrame([(1, 3)], "c_custkey bigint, c_nationkey int")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = sorted(r.year for r in driver_tables.orders_base(orders, customer).collect())
            assert got == [2020 + driver_tables.FBS_YEAR_SHIFT, 2021 + driver_tables.FBS_YEAR_SHIFT]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_T14_csv_null_words(spark):
    df = spark.createDataFrame([(w,) for w in ["NA", "N/A", "null", "nan", "", "Namibia"]], "Area string")
    got = [r.Area for r in csv_ingest.prepare(df, "f.csv", datetime(2024, 1, 1)).collect()]
    assert got == [None, None, None, None, None, "Namibia"]


def test_T15_csv_doubled_quotes(spark, tmpdir_fresh):
    p = Path(tmpdir_fresh) / "q.csv"
    p.write_text('Area,Value\n"say ""hi"", ok",1\n"two\nlines",2\n', encoding="utf-8")
    # quoted line breaks are opted into: they keep a file from being split over tasks
    rows = csv_ingest.read_csv(spark, str(p), multi_line=True).collect()
    assert [(r.Area, r.Value) for r in rows] == [('say "hi", ok', "1"), ("two\nlines", "2")]
    assert csv_ingest.read_csv(spark, str(p)).first()["Area"] == 'say "hi", ok'
