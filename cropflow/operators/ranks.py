"""Exact per-group ranks and quantiles without gathering a large group in one task.

`value_weights` aggregates to one stored row per (group, value), so a hot value
costs one row. `prefix_weights` returns, for each of them, the total weight at
that value, the total weight of strictly smaller values in the group (`before`)
and the group total:

1. groups of at most `bound` distinct values are one segment, sorted in one task;
2. a larger group is cut by equi-depth splitters: `percentile_approx`, a
   mergeable quantile sketch, over the group's distinct values gives `buckets - 1`
   splitters, and a value's segment is the number of splitters below it (a binary
   search in the splitter array). Segments still over the bound are cut again the
   same way, so a narrow cluster beside far outliers spreads like any other;
3. prefix sums run inside a segment, and segment totals give each its offset.

Splitters and segments are written before they are used, so the segment of a
value is the same wherever the plan reads it. From the prefix weights: exact
quantiles with linear interpolation (pandas / numpy default), average ranks for
ties (Spearman), and weighted "count below" queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

G = "__grp"
#: Distinct values of a group that one task sorts; segments that a larger group is cut into at a time.
BOUND, BUCKETS = 1 << 18, 1 << 10


def with_group(df: DataFrame, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Grouping columns, or one constant group for a whole-series statistic."""
    if group_cols:
        return df, list(group_cols)
    return df.withColumn(G, F.lit(0)), [G]


def value_weights(df: DataFrame, group_cols: list[str], value_col: str,
                  weight: Column | None = None) -> DataFrame:
    """(group..., value, w), stored: one row per distinct value, NULL included."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    return written(df.groupBy(*group_cols, value_col).agg(F.sum(w).alias("w")), "weights")


def splitters_below(splitters: Column, value: Column, size: int) -> Column:
    """Number of ascending splitters smaller than the value, by binary search."""
    steps = [1 << k for k in reversed(range(size.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(x) for x in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= F.size(splitters))
                                & (F.get(splitters, at + step - 1) < value), at + step).otherwise(at))


def segmented(rows: DataFrame, group_cols: list[str], value_col: str, bound: int = BOUND,
              buckets: int = BUCKETS) -> DataFrame | None:
    """rows + `__seg`, a long that never decreases with the value in a group and divides it into
    parts of at most `bound` rows (equal values stay together); None if no group needs it."""
    keys, keyed, most = [*group_cols, "__seg"], rows.withColumn("__seg", F.lit(0).cast("long")), None
    probs = [k / buckets for k in range(1, buckets)]
    while True:
        sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        worst = sizes.agg(F.max("__n")).first()[0] or 0
        if worst <= bound or worst == most or not probs:  # equal doubles can't be cut further
            return keyed if most else None
        most, crowded = worst, sizes.where(F.col("__n") > bound)
        sketch = F.percentile_approx(value_col, probs, 10_000).alias("__cuts")
        cuts = written(keyed.join(crowded.drop("__n"), keys).groupBy(*keys).agg(sketch), "splitters")
        below = F.coalesce(splitters_below(F.col("__cuts"), F.col(value_col), buckets), F.lit(0))
        keyed = written(keyed.join(cuts, keys, "left").select(
            *rows.columns, (F.col("__seg") * buckets + below).alias("__seg")), "segments")


def prefix_weights(df: DataFrame, group_cols: list[str], value_col: str,
                   weight: Column | None = None, buckets: int = BUCKETS, bound: int = BOUND) -> DataFrame:
    """(group..., value, w, before, total) for every distinct non-NULL value."""
    return prefix_of(value_weights(df, group_cols, value_col, weight), group_cols, value_col, buckets, bound)


def prefix_of(weights: DataFrame, group_cols: list[str], value_col: str,
              buckets: int = BUCKETS, bound: int = BOUND) -> DataFrame:
    """`prefix_weights` of stored value weights."""
    vc = weights.where(F.col(value_col).isNotNull())
    keyed = segmented(vc, group_cols, value_col, bound, buckets)
    group, below = Window.partitionBy(*group_cols), (Window.unboundedPreceding, -1)
    if keyed is None:
        before = F.sum("w").over(group.orderBy(value_col).rowsBetween(*below))
        return vc.select(*group_cols, value_col, "w", F.coalesce(before, F.lit(0)).alias("before"),
                         F.sum("w").over(group).alias("total"))
    totals = keyed.groupBy(*group_cols, "__seg").agg(F.sum("w").alias("__part"))
    totals = totals.select(
        *group_cols, "__seg",
        F.coalesce(F.sum("__part").over(group.orderBy("__seg").rowsBetween(*below)), F.lit(0)).alias("__offset"),
        F.sum("__part").over(group).alias("total"))
    local = Window.partitionBy(*group_cols, "__seg").orderBy(value_col).rowsBetween(*below)
    keyed = keyed.withColumn("__local", F.coalesce(F.sum("w").over(local), F.lit(0)))
    return keyed.join(totals, [*group_cols, "__seg"]).select(
        *group_cols, value_col, "w", (F.col("__local") + F.col("__offset")).alias("before"), "total")


def attach_ranks(rows: DataFrame, group_cols: list[str], value_cols: dict[str, str],
                 buckets: int = BUCKETS, bound: int = BOUND) -> DataFrame:
    """Stored weighted rows (group..., values..., w) + the average rank of each value column
    (value -> name of its rank) among the group's weight, and the group's weight `__n`.

    Groups of at most `bound` rows are ranked by windows over one exchange. Otherwise ranks
    come from the distinct values; a value held by more than `bound` rows (there are fewer
    than rows / bound of them) meets its rows through a small table of such values of its own,
    so its rows stay where they are, and the others are joined on the value.
    """
    group = Window.partitionBy(*group_cols)
    counts = rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if counts <= bound:
        out = rows.withColumn("__n", F.sum("w").over(group))
        for v, name in value_cols.items():
            upto = F.sum("w").over(group.orderBy(v).rangeBetween(Window.unboundedPreceding, Window.currentRow))
            ties = F.sum("w").over(Window.partitionBy(*group_cols, v))
            out = out.withColumn(name, upto - ties + (ties + 1) / F.lit(2.0))
        return out
    out = rows
    for v, name in value_cols.items():
        held = written(rows.groupBy(*group_cols, v).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("__rows")), "held")
        ranked = average_ranks(prefix_of(held.drop("__rows"), group_cols, v, buckets, bound), v, name)
        ranked = written(ranked.select(*group_cols, v, name, F.col("total").alias("__n")), "ranked")
        often = written(ranked.join(held.where(F.col("__rows") > bound).select(*group_cols, v), [*group_cols, v], "left_semi"), "often")
        keep = [c for c in out.columns if c != "__n"]
        marked = out.select(*keep).join(often, [*group_cols, v], "left")
        met = marked.where(F.col(name).isNotNull())
        rest = marked.where(F.col(name).isNull()).select(*keep).join(ranked, [*group_cols, v])
        out = written(met.select(*keep, name, "__n").unionByName(rest.select(*keep, name, "__n")), "with-ranks")
    return out


def average_ranks(pw: DataFrame, value_col: str, rank_col: str) -> DataFrame:
    """1-based average rank of each distinct value (ties share the mean rank)."""
    return pw.withColumn(rank_col, F.col("before") + (F.col("w") + F.lit(1)) / F.lit(2.0))


def quantiles(pw: DataFrame, group_cols: list[str], value_col: str,
              probs: dict[str, float]) -> DataFrame:
    """Exact quantiles, linear interpolation between the closest ranks.

    Position h = (n - 1) p; result = lerp(x[floor h], x[ceil h], h - floor h) as numpy
    computes it, where x[i] is the value whose run [before, before + w) holds index i.
    """
    v, b, w, n = F.col(value_col), F.col("before"), F.col("w"), F.col("total")
    aggs = []
    for name, p in probs.items():
        h = (n - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((b <= lo) & (lo < b + w), v)).alias(f"{name}__lo"),
                 F.max(F.when((b <= hi) & (hi < b + w), v)).alias(f"{name}__hi"),
                 F.max(h - lo).alias(f"{name}__frac")]
    q = pw.groupBy(*group_cols).agg(*aggs)
    return q.select(*group_cols, *[lerp(F.col(f"{k}__lo"), F.col(f"{k}__hi"), F.col(f"{k}__frac")).alias(k)
                                   for k in probs])


def lerp(a: Column, b: Column, t: Column) -> Column:
    """numpy's linear interpolation: a + (b - a) t, or b - (b - a)(1 - t) when t >= 0.5."""
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)
