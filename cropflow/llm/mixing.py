"""Operator 8: mixing sources to target weights along a time-varying curriculum, DataFrame operations only.

Targets: the sources, ordered by name (null last), weigh 3, 1, 2 in turn and
share ``BUDGET`` times all words; none may exceed ``MOST`` times its own
words, the excess goes to the others by weight. The share is the water level
at which the capped sources (smallest cap per weight first) leave exactly the
rest; it is computed in whole numbers with one final division.

Curriculum: over training time t in [0, 1] a source's sampling rate changes
linearly, rate(t) = target * (1 + slope * (2 t - 1)). Its integral, the words
demanded up to t, is target * (t + slope * (t*t - t)); inverting it gives the
time at which a document's first word is due. Within a source documents follow
in order of a hash of their id, and start over when the demand passes the
source's own words; the last document is taken up to the word that meets the
target. Sorting by that time is one range partitioning of the documents.

Plan: word counts are one scan, written once without texts. Running totals
inside a source use two levels: fine hash buckets (about ``BUCKET_ROWS`` rows)
are summed, the sums are accumulated per source, and rows accumulate inside
their bucket only, so a source that holds a third of all rows spreads over all
tasks. The sources table (one row per source) is the only thing ever in one task.

Edge cases: a null text has size 0 and takes nothing; a null source is a
source of its own; a null id hashes as the empty text; repeated rows are
separate documents; no rows, or no words at all, give targets of 0; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Fixed values of the mix: weights by turn, share of all words in halves, cap per source.
WEIGHTS, BUDGET_HALVES, MOST = (3, 1, 2), 3, 2
#: Slope of each source's rate by turn: early, late, even.
SLOPES = (-0.5, 0.5, 0.0)
BUCKET_ROWS = 20_000

WORD = r"[^\x20\x09-\x0D]+"


def _in_turn(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), ((index - 1) % len(values) + 1).cast("int"))


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size) -> plus weight, slope and target words."""
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    s = sources.withColumn("turn", turn).select(
        "source", "source_size", _in_turn(WEIGHTS, F.col("turn")).cast("long").alias("weight"),
        _in_turn(SLOPES, F.col("turn")).alias("slope"), "turn", (F.col("source_size") * MOST).alias("cap"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = (s.withColumn("halves", F.sum("source_size").over(whole) * BUDGET_HALVES - 2 * F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("weights", F.sum("weight").over(rest))
         .withColumn("full", 2 * F.col("cap") * F.col("weights") <= F.col("halves") * F.col("weight")))
    # what the first source below its cap sees holds for all of them
    s = s.withColumn("at", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "turn", "halves", "weights"))).over(whole))
    share = F.col("weight") * F.col("at.halves") / (F.lit(2.0) * F.col("at.weights"))
    return s.select("source", "source_size", "weight", "slope",
                    F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def due_time(words: Column, target: Column, slope: Column) -> Column:
    """Training time in [0, 1] at which a source has been asked for ``words`` words (inverse of the integral)."""
    y = words / target
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * y)
    return F.when(target > 0, F.when(slope == 0, y).otherwise(2 * y / ((1 - slope) + root)))


def mix(docs: DataFrame) -> DataFrame:
    """docs (doc_id, source, size) -> doc_id, size, source_size, target, taken_first, taken_again,
    taken, position, position_again. ``docs`` is read several times: pass a written table.
    Positions are null where nothing is taken."""
    rows = docs.count()
    digits = max(1, math.ceil(math.log(max(1, rows) / BUCKET_ROWS, 16))) if rows > BUCKET_ROWS else 1
    sources = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")))
    # rows without an id are spread by their size
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none "), F.col("size").cast("string")))
    order = F.md5(named.cast("binary"))
    d = docs.withColumn("h", order).withColumn("bucket", F.substring("h", 1, digits))
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                         F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = (d.join(begins, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
         .withColumn("start", F.col("base") + F.col("ahead")).drop("s", "b"))
    t = sources.withColumnRenamed("source", "s")
    d = d.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("goal", F.floor("target"))
    zero = F.lit(0).cast("long")
    first = F.greatest(zero, F.least(F.col("size"), F.col("goal") - F.col("start")))
    again = F.greatest(zero, F.least(F.col("size"), F.col("goal") - F.col("source_size") - F.col("start")))
    d = d.withColumn("taken_first", first).withColumn("taken_again", again)
    when = lambda taken, start: F.when(F.col(taken) > 0, due_time(start, F.col("target"), F.col("slope")))
    return d.select(*[c for c in docs.columns if c != "source"], "source_size", "target", "taken_first", "taken_again",
                    (F.col("taken_first") + F.col("taken_again")).alias("taken"),
                    when("taken_first", F.col("start")).alias("position"),
                    when("taken_again", F.col("start") + F.col("source_size")).alias("position_again"))


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, source, size (and ``keep``) of every document, written once."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return written(docs.select("doc_id", "source", size.alias("size"), *keep), "mix-sizes")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mixed = mix(sized(docs)).select("doc_id", "size", "source_size", "target", "taken", "position")
    return mixed.orderBy(F.asc_nulls_last("position"), "doc_id")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), 'none ' || CAST(size AS VARCHAR))) AS h FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(turn - 1) % 3 + 1] AS weight, [-0.5, 0.5, 0.0][(turn - 1) % 3 + 1] AS slope, 2 * source_size AS cap FROM s),
l AS (
  SELECT *, 3 * sum(source_size) OVER () - 2 * COALESCE(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS halves,
         sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
f AS (SELECT *, 2 * cap * weights <= halves * weight AS is_full FROM l),
a AS (SELECT halves, weights FROM f WHERE NOT is_full ORDER BY CAST(cap AS DOUBLE) / weight, turn LIMIT 1),
t AS (
  SELECT f.source, f.source_size, CAST(f.slope AS DOUBLE) AS slope,
         CASE WHEN is_full THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * a.halves AS DOUBLE) / (2.0 * CAST(a.weights AS DOUBLE)) END AS target
  FROM f LEFT JOIN a ON true),
o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, CAST(floor(t.target) AS BIGINT) AS goal,
         COALESCE(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - source_size - start)) AS BIGINT) AS taken,
       CASE WHEN greatest(0, least(size, goal - start)) > 0 THEN
         CASE WHEN slope = 0 THEN start / target
              ELSE 2 * (start / target) / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * (start / target))) END END AS position
FROM o
"""
