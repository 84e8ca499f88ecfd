"""Connected components of an edge table, DataFrame operations only.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round hangs a node's larger
neighbours under its smallest one, so paths shrink geometrically and the
result is one star per component. A node's smallest neighbour comes from a
partially aggregated minimum and is joined back (AQE splits a hub's rows), no
neighbour list is ever gathered, and each round is cut by a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _under_smallest(pairs: DataFrame, with_self: bool) -> DataFrame:
    """pairs (u, v): v hung under the smallest of u and its neighbours; u itself too, if asked."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    hung = pairs.join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if with_self:
        hung = hung.unionByName(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges (a, b), any orderable type -> (node, root): the smallest node reachable from
    each node that has an edge to another. Null ends and self-loops are ignored."""
    edges = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    current, mark = written(edges, name), None
    while True:
        new = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(new) == mark or not new["n"]:
            break
        mark = tuple(new)
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: of each node's neighbours, only the larger ones move
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        current = written(_under_smallest(large, with_self=True), name)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
