"""Operator 2 on different texts without an id whose 32-bit hashes are equal."""

import random

from pyspark.sql import functions as F

from cropflow.llm import suffixes

from . import brute


def test_texts_of_one_hash_are_told_apart(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(600))
    numbers = spark.range(200_000)
    long = numbers.select(F.concat(F.lit(passage), F.col("id").cast("string")).alias("a")).withColumn("h", F.hash("a"))
    short = numbers.select(F.concat(F.lit("a short text "), F.col("id").cast("string")).alias("b")).withColumn("h", F.hash("b"))
    a, b = long.join(short, "h").orderBy("a", "b").select("a", "b").first()
    rows = [(None, a), (None, b), (1, "x" + passage), (2, "y " * 10)]
    got = suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.suffix_dedup(rows)))
