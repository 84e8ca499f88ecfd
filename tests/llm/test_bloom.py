"""The Bloom filter is collected without a Python row for each of its words."""

import tracemalloc

import numpy as np
import pytest

from cropflow.llm import bloom


@pytest.fixture()
def without_arrow(spark):
    """A session in which toPandas() goes through rows, as Spark's default is."""
    was = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    yield
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", was)


def _plain(hashes):
    """The filter set bit by bit."""
    log = bloom.bits_for(len(hashes)).bit_length() - 1
    out = np.zeros((1 << log) >> 6, dtype=np.uint64)
    for h in hashes:
        for spot in (h % (1 << 64) >> 64 - log, h % (1 << log)):
            out[spot >> 6] |= np.uint64(1 << (spot & 63))
    return out


def test_filter_is_collected_in_little_memory(spark, without_arrow):
    values = spark.range(200_000).selectExpr("xxhash64(id) AS h")
    hashes = np.array(values.toPandas()["h"], dtype=np.int64)
    bloom.build(values.limit(10), "h")
    tracemalloc.start()
    try:
        words = bloom.build(values, "h")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert bloom.maybe(words, hashes.view(np.uint64)).all()
    assert peak < 4 * words.nbytes, f"{peak} bytes for a filter of {words.nbytes}"


@pytest.mark.parametrize("n", [0, 1, 3_000])
def test_filter_matches_plain(spark, without_arrow, n):
    values = spark.range(n).selectExpr("xxhash64(id) AS h")
    words = bloom.build(values, "h")
    assert words.tolist() == _plain([r.h for r in values.collect()]).tolist()
