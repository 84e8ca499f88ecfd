"""A Bloom filter of bounded size over 64-bit hashes, built by a DataFrame aggregation.

Used only to skip work: a value outside the filter is certainly not in the
set; a false positive costs time and never changes a result. Its size follows
the set up to ``MAX_BITS`` (32 MB), which bounds what is collected and broadcast
at any input size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 28
_BITS_PER_VALUE = 16


def bits_for(count: int) -> int:
    return min(MAX_BITS, max(1 << 10, 1 << (count * _BITS_PER_VALUE - 1).bit_length()))


def build(values: DataFrame, column: str) -> np.ndarray:
    """uint64 words of the filter of ``column`` (long, well mixed). Read twice: pass a written table."""
    log = bits_for(values.count()).bit_length() - 1
    h = F.col(column)
    # two positions from disjoint bits of the hash
    spots = F.array(F.shiftrightunsigned(h, 64 - log), h.bitwiseAND(F.lit((1 << log) - 1)))
    spot = values.select(F.explode(spots).alias("spot"))
    # as Arrow whatever the session's settings: toPandas() may make a Python row of each of up to 4,194,304 words
    words = (spot.groupBy(F.shiftright("spot", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("mask")).toArrow())
    out = np.zeros((1 << log) >> 6, dtype=np.uint64)
    for batch in words.to_batches():
        out[batch.column("word").to_numpy()] = batch.column("mask").to_numpy().view(np.uint64)
    return out


def maybe(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where the value may be in the set."""
    log = np.uint64(len(words).bit_length() - 1 + 6)
    out = np.ones(len(hashes), dtype=bool)
    for spot in (hashes >> (np.uint64(64) - log), hashes & ((np.uint64(1) << log) - np.uint64(1))):
        out &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out
