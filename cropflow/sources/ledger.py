"""An append-only ledger of loads, and reconciliation against it.

A load is written once; its rows and an order-free hash of their content are
observed in that same pass, and one line (source, instant, rows, hash, target)
is appended to the ledger. Reconciling counts and hashes the stored table anew
and compares it with the ledger's last line for the source, so a table is never
compared with itself.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

LEDGER = "source string, loaded_at timestamp, rows long, content string, target string"


def content_hash(columns: list[str]) -> Column:
    """An aggregate that depends on the rows and their number, not on their order."""
    nulls = F.xxhash64(*[F.col(c).isNull() for c in columns])  # a hash alone passes over NULL
    row = F.xxhash64(*columns, nulls)
    return F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string")


def observed_write(df: DataFrame, target: str, name: str) -> tuple[int, str]:
    """Writes `df` (full replace) and returns its rows and content hash, observed in the same pass."""
    seen = Observation(name)
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), content_hash(df.columns).alias("content"))
    observed.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return seen.get["rows"], seen.get["content"]


def append(spark: SparkSession, ledger: str, lines: list[tuple[str, int, str, str]], loaded_at: datetime | None = None) -> None:
    """Adds a line per load (source, rows, content, target), in one write."""
    instant = loaded_at or datetime.now(timezone.utc)
    rows = [(source, instant, n, content, target) for source, n, content, target in lines]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def load(df: DataFrame, target: str, ledger: str, source: str, loaded_at: datetime | None = None) -> DataFrame:
    """Writes `df` (full replace) and its ledger line; returns the stored table."""
    rows, content = observed_write(df, target, f"load-{source}")
    append(df.sparkSession, ledger, [(source, rows, content, target)], loaded_at)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def last_loads(spark: SparkSession, ledger: str) -> DataFrame:
    """The last ledger line of each source."""
    newest = Window.partitionBy("source").orderBy(F.desc("loaded_at"), F.desc("target"))
    lines = spark.read.schema(LEDGER).parquet(ledger)
    return lines.withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__nth")


def reconcile(spark: SparkSession, ledger: str, stored: dict[str, DataFrame]) -> DataFrame:
    """source, ledger_rows, stored_rows, difference, same_content, status; a source without a line has
    NULL rows and status FAIL. PASS needs equal rows and equal content."""
    found = None
    for source, df in stored.items():
        one = df.agg(F.count(F.lit(1)).alias("stored_rows"), content_hash(df.columns).alias("stored_content")).select(F.lit(source).alias("source"), "*")
        found = one if found is None else found.unionByName(one)
    lines = last_loads(spark, ledger).select(F.col("source").alias("__source"), F.col("rows").alias("ledger_rows"), "content")
    both = found.join(lines, F.col("source") == F.col("__source"), "left")
    same = F.coalesce(F.col("content") == F.col("stored_content"), F.lit(False))
    diff = F.abs(F.col("ledger_rows") - F.col("stored_rows"))
    passed = same & F.coalesce(diff == 0, F.lit(False))
    return both.select("source", "ledger_rows", "stored_rows", diff.alias("difference"), same.alias("same_content"),
                       F.when(passed, "PASS").otherwise("FAIL").alias("status"))
