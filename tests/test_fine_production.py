"""The fine production table is grouped once, by codes; the uniqueness test counts fingerprints in tasks of their own."""

import datetime
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cropflow.operators import dq
from cropflow.sources import driver_tables

DAY = datetime.datetime(1995, 3, 1)
ROWS = [  # suppkey, partkey, linenumber, quantity, flag, status, day
    (1, 7, 1, 3.0, "A", "F", DAY), (1, 7, 2, 4.5, "A", "O", DAY), (1, 7, 3, 20.0, "R", "F", DAY), (1, 7, 4, 6.0, "N", "O", DAY),
    (1, 7, 1, 9.0, "A", "F", DAY.replace(year=1996)), (1, 7, 1, 9.0, "A", "F", DAY.replace(year=1996)),
    (2, 7, 2, 8.0, "N", "O", DAY), (2, 7, 6, None, "R", "F", DAY), (2, 8, 3, None, "A", "F", DAY),
    (None, 7, 5, 2.0, "R", "F", DAY), (None, 7, 5, 2.0, "R", "F", DAY), (3, None, 4, 1.0, "N", "F", DAY), (3, 9, 4, 7.0, "R", "F", DAY),
    (4, 9, 1, 0.0, "A", "F", None), (4, 9, 1, 5.0, "N", "F", None), (4, 9, 1, 5.0, "R", "F", None),
    (5, 9, 1, 5.0, "X", "F", DAY), (5, 9, 1, 5.0, None, "F", DAY),
]


@pytest.fixture()
def fine(spark, tmpdir_fresh):
    li = spark.createDataFrame(ROWS, "l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    li.repartition(4).write.parquet(f"{tmpdir_fresh}/lineitem.parquet")
    return driver_tables.fine_production(spark, tmpdir_fresh)


def _plain():
    def add(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    groups = defaultdict(list)
    for supp, part, line, qty, flag, _, day in ROWS:
        if flag in ("A", "N", "R"):
            groups[supp, part, day and day.year + 10].append((flag, qty, line))
    for (supp, part, year), rows in groups.items():
        qty, lines = ({f: add(r[k] for r in rows if r[0] == f) for f in "ANR"} for k in (1, 2))
        crop = qty["N"]
        if crop is not None and (qty["A"] or 0) > 0 and qty["R"] is not None:
            crop = float(math.floor(qty["R"] * 10000 / qty["A"] * (1 + (lines["N"] % 13 - 6) / 50)))
        for code, value, n in ((5312, qty["A"], lines["A"]), (5417, crop, lines["N"]), (5510, qty["R"], lines["R"])):
            if value is not None:
                flag = driver_tables.ADAPTER_FLAGS[n % 8]
                yield (supp, None if supp is None else f"Supplier {supp}", part, None if part is None else f"Part {part}", code, year,
                       None if flag == "M" else value, flag)


def test_line_items_meet_once_with_the_same_rows(fine):
    got = fine.select("Area_Code", "Area", "Item_Code", "Item", "Element_Code", "Year", "Value", "Flag").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _plain()))
    assert fine.columns == driver_tables.RAW_COLUMNS


def test_line_items_are_grouped_once_by_codes(fine):
    plan = fine._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    keys = re.findall(r"HashAggregate\(keys=\[([^]]*)\]", plan)
    assert len(keys) == 2 and all(k.count(",") == 2 and "name" not in k for k in keys)


def test_names_after_the_grouping_equal_names_before(fine, spark, tmpdir_fresh):
    li = spark.createDataFrame([(1, "Supplier 1", False, 5, "Part 5", 2005, "A", 2.0, 1), (1, "Supplier 1", False, 5, "Part 5", 2005, "R", 3.0, 2)],
                               "area_code long, area_name string, is_aggregate boolean, item_code long, item_name string, year long, l_returnflag string, qty double, lines long")
    names = {"area_name": "concat('Supplier ', area_code)", "is_aggregate": "false", "item_name": "concat('Part ', item_code)"}
    late = driver_tables.production_raw(li.drop(*names), {k: F.expr(v) for k, v in names.items()})
    assert sorted(map(str, late.collect())) == sorted(map(str, driver_tables.production_raw(li).collect()))


def test_fingerprints_are_counted_apart_from_the_model(spark):
    df = spark.createDataFrame([(k,) for k in ["a", "a", "b", None, None, "c", "d", "d", "d"]], "k string")
    found = dq.unique(df.groupBy("k").count().unionByName(df.groupBy("k").count().where("count > 1")), "m", "k")
    assert found.collect()[0]["failures"] == 2
    plan = dq.unique(df, "m", "k")._jdf.queryExecution().executedPlan().toString()
    nodes = [line for line in plan.splitlines() if "HashAggregate(keys=[__h" in line or "Exchange" in line]
    counted = [i for i, line in enumerate(nodes) if "HashAggregate(keys=[__h" in line]
    assert "REBALANCE" in nodes[counted[-1] + 1]
    assert dq.unique(df, "m", "k").collect()[0]["failures"] == 2
