"""Operator 3: substring deduplication with difference-cover anchors.

A word is removed when a window of ``WINDOW`` consecutive words that covers it
also starts in a document with a smaller id. COVER is a difference cover
modulo PERIOD: for any two positions some shift below PERIOD takes both into
the cover. So two equal windows share an equal sub-window (*anchor*) of
WINDOW - PERIOD + 1 words that starts at a cover position in both documents,
and only anchors at cover positions need hashing (6 of 31 positions).

Plan: 1. anchors are hashed in one map over whole texts and aggregated
(smallest and largest document per anchor, pre-aggregated map-side); anchors
of two or more documents go into a bounded Bloom filter. 2. A second map
extends: the windows around anchors that pass are hashed whole, and the
smallest document of each window hash is aggregated the same way; windows met
in a larger document are joined back (AQE splits a hot window's rows). 3. The
starts of removed windows are gathered per document (bounded by the document),
written, and joined to the texts. Shuffled rows are freed after each step. No document
pairs are formed, so groups of copies cost rows in proportion to their size.

Words are compared by 64-bit hashes of their windows. Edge cases: null text
has no words; a null id is never smaller than another and loses nothing;
rows that repeat an id are judged one by one (a window in a row of the same id
is no reason to remove); texts under ``WINDOW`` words stay whole; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .store import free_shuffles, written
from .text import Block, blocks, ranges, values, window_hash, word_bounds, word_hashes, word_prefix

WINDOW = 50
#: A perfect difference set modulo 31.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1


def _cover_positions(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index, document) of every anchor start in documents of at least WINDOW words."""
    lengths = np.diff(first)
    counts = np.where(lengths >= WINDOW, lengths - ANCHOR + 1, 0)
    residues = np.array(COVER)
    per_doc = np.where(counts[:, None] > residues, (counts[:, None] - residues - 1) // PERIOD + 1, 0)
    flat = per_doc.ravel()
    start = np.repeat((first[:-1, None] + residues).ravel(), flat) + PERIOD * ranges(flat)
    return start, np.repeat(np.repeat(np.arange(len(lengths)), len(COVER)), flat)


def _hashed(block: Block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_bounds(block)
    return word_prefix(word_hashes(block.data, starts, ends)), first


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = values(batch, "doc_id")
        for block in blocks(batch, "text"):
            prefix, first = _hashed(block)
            start, doc = _cover_positions(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(window_hash(prefix, start, ANCHOR).view(np.int64)), pa.array(ids[block.rows][doc])], ["h", "doc_id"])


def _windows(filter_words):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = filter_words.value
        for batch in batches:
            ids, keys, keys2 = values(batch, "doc_id"), values(batch, "row"), values(batch, "row2")
            for block in blocks(batch, "text"):
                prefix, first = _hashed(block)
                start, doc = _cover_positions(first)
                hit = bloom.maybe(words, window_hash(prefix, start, ANCHOR))
                # windows that hold a shared anchor start up to WINDOW - ANCHOR words before it
                edge = np.zeros(int(first[-1]) + 2, dtype=np.int32)
                low = np.maximum(start[hit] - (WINDOW - ANCHOR), first[doc[hit]])
                high = np.minimum(start[hit], first[doc[hit] + 1] - WINDOW)
                np.add.at(edge, low, 1)
                np.add.at(edge, high + 1, -1)
                at = np.flatnonzero(np.cumsum(edge) > 0)
                of = np.searchsorted(first, at, side="right") - 1
                rows = block.rows[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(window_hash(prefix, at, WINDOW).view(np.int64)), pa.array(ids[rows]),
                     pa.array(keys[rows]), pa.array(keys2[rows]), pa.array((at - first[of]).astype(np.int32))], ["h", "doc_id", "row", "row2", "at"])
    return extend


def _shared(rows: DataFrame) -> DataFrame:
    """Hashes met in two documents or more, with the smallest."""
    return rows.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")


def removed_windows(docs: DataFrame) -> DataFrame:
    """docs (doc_id, row, row2, text), ids not null -> doc_id, row, row2, starts: removed windows by their first word."""
    spark = docs.sparkSession
    anchors = docs.select("doc_id", "text").mapInArrow(_anchors, "h long, doc_id long")
    shared = written(_shared(anchors).select("h"), "substring-anchors")
    free_shuffles(spark)
    found = spark.sparkContext.broadcast(bloom.build(shared, "h"))
    windows = docs.mapInArrow(_windows(found), "h long, doc_id long, row long, row2 int, at int")
    # written, so that both sides are dealt for the join alone and Spark can split a window that many documents share
    doubled = written(_shared(windows).select(F.col("h").alias("g"), "least"), "substring-windows")
    free_shuffles(spark)
    met = windows.join(doubled, F.col("h") == F.col("g")).where("doc_id > least")
    # written, so that the shuffled windows are gone from disk before the texts are shuffled
    removed = written(met.groupBy("doc_id", "row", "row2").agg(F.collect_list("at").alias("starts")), "substring-removed")
    free_shuffles(spark)
    return removed


def _cover(starts: np.ndarray, n: int) -> np.ndarray:
    """Words of a document covered by windows at ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _strip(with_text: bool):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column("text"), batch.column("starts")
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for text, at in zip(texts, starts):
                words = _split(text.as_py())
                if at.is_valid:
                    gone = _cover(at.values.to_numpy(), len(words))
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined.decode("utf-8", "replace"))
            out = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(out + [pa.array(kept_texts, pa.string())] * with_text, names + ["kept_text"] * with_text)
    return strip


def _split(text: str | None) -> list[bytes]:
    """Words of a text; bytes.split() separates at exactly the six ASCII space characters."""
    return text.encode("utf-8").split() if text else []


def deduplicate(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""
    # rows that share an id are told apart by 96 bits of two hashes of their text; equal rows fare alike
    keyed = docs.select("doc_id", F.xxhash64("text").alias("row"), F.hash("text").alias("row2"), "text")
    gone = removed_windows(keyed.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()))
    joined = keyed.join(gone, ["doc_id", "row", "row2"], "left").select("doc_id", "text", "starts")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(_strip(with_text), schema)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
