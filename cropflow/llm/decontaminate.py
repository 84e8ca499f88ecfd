"""Operator 1: benchmark decontamination by SimHash fingerprints of item-sized windows.

A document is contaminated by an item of n words if one of its windows of n
words has a weighted-shingle similarity of ``SIMILARITY`` or more with it: the
sum of the smaller over the sum of the larger count, over all 5-word shingles
of window and item; a shorter document is one window as a whole. An item under
five words has one shingle, all of it, so a window must equal it. Words are
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.

1. Screen: a similar window holds at least 80 % of the item's shingles, so only
   documents that hold that many occurrences of an item's shingles can match
   it, and only windows that hold one need a fingerprint.
2. SimHash: each such window of the item's size gets a 256-bit fingerprint
   (signs of the count-weighted sums of its shingle hashes' bits), from running
   sums over the region.
3. Multi-index: fingerprints are cut into BLOCKS blocks of 16 bits, each with a
   table from block value to items. Within RADIUS differing bits some block
   differs in at most RADIUS // BLOCKS, so the table entries at every value that
   near return all item fingerprints within the radius; a random pair meets in
   some block with a chance of 16 %. RADIUS is four standard deviations beyond
   the distance expected at the similarity threshold, so nearly every window
   there lies within it, and of those more similar practically all.
4. Candidates are verified by their exact weighted similarity.

Plan: one map over whole texts per part of the benchmark. Items are dealt by
hash into parts of at most about ``PART_WORDS`` words; each part is broadcast
(bounded by construction), so a benchmark of any size takes more passes, never
more memory. No shuffle of documents.

Edge cases: null texts hold no window; a text shorter than an item is verified
as a whole, without a fingerprint; items that are null or without words take no part;
null ids and repeated rows are judged like others; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Block, blocks, fold_ascii, mix64, ranges, window_hash, word_bounds, word_hashes, word_prefix

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 63, 16
#: Windows whose fingerprints are looked up together.
PROBE_WINDOWS = 2_048
PART_WORDS = 200_000
_SCREEN_BITS = 22


def shingles(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """(block, shingle hash at every word, first word of each document); the hash is 0 where none starts."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for block in blocks(batch, "text"):
        data = fold_ascii(block.data)
        starts, ends, first = word_bounds(Block(block.rows, data, block.offsets))
        prefix = word_prefix(word_hashes(data, starts, ends))
        at = np.arange(max(0, len(starts) - size + 1))
        h = np.zeros(len(starts), dtype=np.uint64)
        h[: len(at)] = window_hash(prefix, at, size)
        over = np.maximum(first[1:] - size + 1, first[:-1])  # the last words of a document start no shingle
        tail = first[1:] - over
        h[np.repeat(over, tail) + ranges(tail)] = 0
        yield block, h, first


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash (four 64-bit words) of every run of ``size`` consecutive shingles."""
    words = []
    for k in range(BLOCKS // 4):
        h = mix64(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) if k else hashes
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
        run = np.zeros((len(h) + 1, 64), dtype=np.int32)
        np.cumsum(bits, axis=0, out=run[1:])
        positive = (run[size:] - run[:-size]) > 0
        words.append(np.packbits(positive, axis=1, bitorder="little").view("<u8").ravel())
    return np.stack(words, axis=1)


#: All changes of a 16-bit value in at most RADIUS // BLOCKS bits.
_CHANGES = np.flatnonzero(np.bitwise_count(np.arange(1 << 16, dtype=np.uint32)) <= RADIUS // BLOCKS).astype(np.int64)


class BlockIndex:
    """Tables from the values of 16-bit blocks to fingerprints."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = prints.view("<u2").reshape(len(prints), BLOCKS)
        self.holder = [np.argsort(values[:, b], kind="stable") for b in range(BLOCKS)]
        self.begin = [np.searchsorted(values[h, b], np.arange((1 << 16) + 1)) for b, h in enumerate(self.holder)]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, held fingerprint) pairs with at most RADIUS differing bits."""
        pairs = [np.zeros(0, np.int64)]
        for at in range(0, len(prints), PROBE_WINDOWS):
            values = prints[at : at + PROBE_WINDOWS].view("<u2").reshape(-1, BLOCKS)
            for b in range(BLOCKS):
                own, which = np.unique(values[:, b], return_inverse=True)
                probe = own.astype(np.int64)[:, None] ^ _CHANGES
                count = self.begin[b][probe + 1] - self.begin[b][probe]
                u, c = np.nonzero(count)
                n = count[u, c]
                found = self.holder[b][np.repeat(self.begin[b][probe[u, c]], n) + ranges(n)]
                u = np.repeat(u, n)
                # each value's finds for each query that has the value
                finds = np.bincount(u, minlength=len(own))
                times = finds[which]
                query = np.repeat(np.arange(len(which)), times)
                place = np.repeat((np.cumsum(finds) - finds)[which], times) + ranges(times)
                pairs.append((query + at) * len(self.prints) + found[place])
        query, held = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.prints)))
        close = np.bitwise_count(prints[query] ^ self.prints[held]).sum(axis=1) <= RADIUS
        return query[close], held[close]


class Items:
    """A part of the benchmark, ready to be broadcast."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.words, self.own = [], [], []
        self.short: dict[int, dict[int, list[int]]] = {}  # words -> hash of all of them -> ids
        for n in range(1, SHINGLE):
            for block, h, first in shingles(pa.array(texts, pa.string()), n):
                for k, row in enumerate(block.rows):
                    if first[k + 1] - first[k] == n:
                        self.short.setdefault(n, {}).setdefault(int(h[first[k]]), []).append(ids[row])
        for block, h, first in shingles(pa.array(texts, pa.string())):
            for k, row in enumerate(block.rows):
                n = int(first[k + 1] - first[k])
                if n >= SHINGLE:
                    self.ids.append(ids[row])
                    self.words.append(n)
                    self.own.append(h[first[k] : first[k + 1] - SHINGLE + 1])
        sizes = np.array([len(o) for o in self.own], dtype=np.int64)
        self.least = np.ceil(SIMILARITY * sizes - 1e-9)
        flat = np.concatenate(self.own) if self.own else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((item, flat))
        pairs = np.unique(np.stack([flat[order], item[order].astype(np.uint64)], axis=1), axis=0) if len(flat) else np.zeros((0, 2), np.uint64)
        self.shingle, at, counts = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        self.holder, self.begin, self.count = pairs[:, 1].astype(np.int64), at, counts  # items that hold each shingle
        self.screen = np.zeros(1 << _SCREEN_BITS, dtype=bool)
        self.screen[(self.shingle >> np.uint64(64 - _SCREEN_BITS)).astype(np.int64)] = True
        prints = np.concatenate([fingerprints(o, len(o)) for o in self.own]) if self.own else np.zeros((0, BLOCKS // 4), np.uint64)
        self.size = np.array(self.words, dtype=np.int64)
        self.index = BlockIndex(prints)

    def candidates(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs with fingerprints within RADIUS, among items of n words."""
        window, item = self.index.within(prints)
        same = self.size[item] == n
        return window[same], item[same]


def _similarity(window: np.ndarray, own: np.ndarray) -> float:
    """Sum of smaller over sum of larger counts of two shingle lists."""
    both, inverse = np.unique(np.concatenate([window, own]), return_inverse=True)
    a = np.bincount(inverse[: len(window)], minlength=len(both))
    b = np.bincount(inverse[len(window) :], minlength=len(both))
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


def _document_leaks(items: Items, h: np.ndarray, at: np.ndarray, holders: list[np.ndarray]) -> list[tuple[int, float, int]]:
    """(item, best similarity, first word) of every item that a document leaks.

    h: shingles of the document; at: places of benchmark shingles; holders: the items of each.
    """
    item = np.concatenate(holders)
    place = np.repeat(at, [len(x) for x in holders])
    met, counts = np.unique(item, return_counts=True)
    met = met[counts >= items.least[met]]
    best: dict[int, tuple[float, int]] = {}
    for n in {items.words[i] for i in met.tolist()}:
        m = n - SHINGLE + 1
        last = len(h) - SHINGLE + 1 - m  # last window start
        wanted = met[[items.words[i] == n for i in met.tolist()]]
        if last < 0:  # the whole document is the one window; too few to need fingerprints
            for j in wanted.tolist():
                s = _similarity(h[: len(h) - SHINGLE + 1], items.own[j])
                if s >= SIMILARITY:
                    best[j] = (s, 0)
            continue
        spots = np.unique(place[np.isin(item, wanted)])
        # windows that hold one of the spots, region by region
        low, high = np.maximum(spots - m + 1, 0), np.minimum(spots, last)
        spots_ok = low <= high
        low, high = low[spots_ok], high[spots_ok]
        if not len(low):
            continue
        new = np.concatenate([[True], low[1:] > high[:-1] + 1])
        for a, z in zip(low[new].tolist(), high[np.append(np.flatnonzero(new)[1:] - 1, len(high) - 1)].tolist()):
            region = h[a : z + m]
            w, i = items.candidates(fingerprints(region, m), n)
            for start, j in zip(w.tolist(), i.tolist()):
                s = _similarity(region[start : start + m], items.own[j])
                if s >= SIMILARITY and s > best.get(j, (0.0, 0))[0]:
                    best[j] = (s, a + start)
    return [(j, s, start) for j, (s, start) in sorted(best.items())]


def _short_leaks(items: Items, texts: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
    """Leaks of items under five words, at their first place."""
    for n, known in items.short.items():
        hashes = np.array(sorted(known), dtype=np.uint64)
        for block, h, first in shingles(texts, n):
            at = np.flatnonzero(np.isin(h, hashes) & (h != 0))
            doc = np.searchsorted(first, at, side="right") - 1
            _, one = np.unique(np.stack([doc.astype(np.uint64), h[at]], axis=1), axis=0, return_index=True)
            for k in one.tolist():
                for item_id in known[int(h[at[k]])]:
                    yield int(block.rows[doc[k]]), item_id, 1.0, int(at[k] - first[doc[k]]), n


def _leaks_of_batch(items: Items, texts: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item id, best similarity, first word, words of the item) of every leak in a batch of texts."""
    yield from _short_leaks(items, texts)
    if not items.own:
        return
    for block, h, first in shingles(texts):
        at = np.flatnonzero(items.screen[(h >> np.uint64(64 - _SCREEN_BITS)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(items.shingle, h[at]), len(items.shingle) - 1)
        real = (items.shingle[spot] == h[at]) & (h[at] != 0)
        at, spot = at[real], spot[real]
        doc = np.searchsorted(first, at, side="right") - 1
        for d, part in zip(*_by_document(doc)):
            hold = [items.holder[items.begin[s] : items.begin[s] + items.count[s]] for s in spot[part].tolist()]
            for j, s, w in _document_leaks(items, h[first[d] : first[d + 1]], at[part] - first[d], hold):
                yield int(block.rows[d]), items.ids[j], s, w, items.words[j]


def _report(shared):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            found = list(_leaks_of_batch(items, batch.column("text")))
            rows, item, similarity, start, words = zip(*found) if found else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(item, pa.int64()),
                 pa.array(similarity, pa.float64()), pa.array(start, pa.int64()), pa.array(words, pa.int64())],
                ["doc_id", "item_id", "similarity", "start_word", "n_words"])
    return report


def _clean(shared):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[row for row, *_ in _leaks_of_batch(items, batch.column("text"))]] = False
            yield batch.filter(pa.array(keep))
    return clean


def _by_document(doc: np.ndarray) -> tuple[list[int], list[slice]]:
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(doc))
    return doc[cuts].tolist(), [slice(a, b) for a, b in zip(cuts.tolist(), ends.tolist())]


def benchmark_parts(benchmark: DataFrame, part_words: int = PART_WORDS) -> Iterator[Items]:
    """The benchmark (item_id, text) in parts of bounded size; parts without a usable item are left out."""
    usable = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text")
    words = usable.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    parts = -(-words // part_words)
    for part in range(parts):
        mine = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        items = Items([r["item_id"] for r in mine], [r["text"] for r in mine])
        if items.own or items.short:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> doc_id, item_id, similarity, start_word
    (first word of the most similar window), n_words (of the item): one row per document row and item it leaks."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    found = [texts.mapInArrow(_report(spark.sparkContext.broadcast(items)), schema) for items in benchmark_parts(benchmark, part_words)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``docs`` (any columns, ``text`` among them) that leak no item; filtered in place, no shuffle."""
    for items in benchmark_parts(benchmark, part_words):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(items)), docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
