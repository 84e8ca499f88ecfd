"""RANK, totals and running sums of large ordered groups in two levels.

A window over (group) sorts a group in one task. Here a group of more than
`bound` rows is cut into segments by equi-depth splitters of its values
(`ranks.segmented`; equal values share a segment, so RANK's ties stay together).
Ranks and sums run inside a segment, and the rows and sums of the segments above
are added as offsets. Segments of a group are counted and summed by one partial
aggregate; their number is the group's rows over the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .ranks import BOUND, BUCKETS, segmented


def ranked_descending(rows: DataFrame, group_cols: list[str], value_col: str, rank: str,
                      total: str | None = None, running: str | None = None, tie: str | None = None,
                      spread: bool = True, bound: int = BOUND, buckets: int = BUCKETS) -> DataFrame:
    """rows + RANK by the value, largest first; with names, the group's total and the running
    sum in that order, equal values in order of `tie`.

    With ``spread=False`` the caller knows that no group is over the bound: plain windows.
    Rows whose value is NULL come last, as one segment or behind the smallest.
    """
    v = F.col(value_col)
    keyed = None
    if spread:
        rows = written(rows, "ranked")
        keyed = segmented(rows, group_cols, value_col, bound, buckets)
    within = list(group_cols) if keyed is None else [*group_cols, "__seg"]
    largest = [v.desc_nulls_last()]
    steps = Window.partitionBy(*within).orderBy(*largest, *([F.col(tie).asc()] if tie else []))
    upto = F.sum(v).over(steps.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.rank().over(Window.partitionBy(*within).orderBy(*largest))
    if keyed is None:
        return _named(rows.columns, rows, (rank, place), (total, F.sum(v).over(Window.partitionBy(*group_cols))), (running, upto))
    parts = keyed.groupBy(*within).agg(F.count(F.lit(1)).alias("__rows"), F.sum(v).alias("__sum"))
    group = Window.partitionBy(*group_cols)
    above = group.orderBy(F.desc("__seg")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    parts = parts.select(*within, F.coalesce(F.sum("__rows").over(above), zero).cast("int").alias("__rows"),
                         F.coalesce(F.sum("__sum").over(above), zero).alias("__sum"), F.sum("__sum").over(group).alias("__total"))
    local = keyed.select("*", place.alias("__place"), upto.alias("__upto"))
    return _named(rows.columns, local.join(parts, within), (rank, F.col("__place") + F.col("__rows")),
                  (total, F.col("__total")), (running, F.col("__upto") + F.col("__sum")))


def _named(columns: list[str], df: DataFrame, *named: tuple[str | None, Column]) -> DataFrame:
    return df.select(*columns, *[c.alias(name) for name, c in named if name])
