"""Join helpers.

`lookup_join` attaches dimension attributes to a fact. A dimension is
broadcast explicitly only when its size is bounded by construction (the
year spine, the element list); otherwise Spark decides: the
planner broadcasts when its size estimate is under
`spark.sql.autoBroadcastJoinThreshold`, and AQE re-plans a sort-merge join
into a broadcast join once the dimension's real size is known. Either way
the fact side is never shuffled for a small dimension, and a dimension
that turns out large falls back to a sort-merge join instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                bounded: bool = False) -> DataFrame:
    right = F.broadcast(dim) if bounded else dim
    keys = [on] if isinstance(on, str) else list(on)
    extra = [c for c in dim.columns if c not in keys]
    return fact.join(right, on=keys, how=how).select(*fact.columns, *extra)


def orphan_keys(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """(key, rows): non-NULL child keys with no parent row, and their number of child rows.

    The child is cut to a count per key within each task before anything is shuffled, so what
    meets the parent is its distinct keys. (A Bloom filter of the parent's keys could not replace
    this: it may pass a key that has no parent, so every passed row would still have to be joined.)
    """
    c = child.where(F.col(child_col).isNotNull()).groupBy(F.col(child_col).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    p = parent.select(F.col(parent_col).alias("__parent_key")).distinct()
    return c.join(p, c["key"] == p["__parent_key"], "left_anti")


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """J12 / relationships test: child rows whose non-NULL key has no parent row."""
    lost = orphan_keys(child, child_col, parent, parent_col).select(F.col("key").alias("__orphan"))
    return child.join(lost, child[child_col] == lost["__orphan"], "left_semi")
