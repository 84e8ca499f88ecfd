"""Operator 2: substring deduplication by suffix arrays of shards.

A byte is removed when a ``window``-byte string (400 by default) that covers it
also starts anywhere else, in the same document or another.

Shards. Every window has a *minimizer*: the position of its smallest hashed
64-byte string (the leftmost of equals), a function of its bytes alone, so equal
windows have equal minimizer strings. Consecutive windows with one minimizer
position form a *stretch*; its key is the hash of that string. All occurrences
of a window therefore lie in stretches of one key, and shards are made of whole
keys.

1. Stretches are counted by (key, content hash) in one map over whole texts,
   texts left behind. A content that occurs twice and shares its key only with
   itself is duplicate throughout; one that occurs once, alone in its key, is
   dropped here, and so are nearly all.
2. Stretches of keys with several contents are dealt finer, by hashes still:
   their windows are split by the distance from the minimizer into classes of
   42, whose windows share a core of all but 41 bytes, and the core's hash
   becomes the key. Listed are these classes, and the duplicate contents of 1.
   A class key with more than ``HOT_CONTENTS`` contents is dealt once more, the
   core then being the window itself, so no shard grows with a shared passage.
3. Only contents whose class holds others too, the borders of repeats, send
   their bytes: they are grouped into shards of bounded size. Each shard builds
   its suffix array by induced sorting (suffix types, sorting of leftmost-smaller
   substrings, recursion on their names, induction in linear time) and permuted
   common prefixes; a window is duplicate if its suffix shares a window's length
   with a neighbour's.
4. Duplicate windows are joined back to the listed stretches, gathered per
   document (bounded by the document) and cut out of the texts.

With ``keep_first`` one occurrence of every repeated string stays, the first by
(doc_id, none last, text hash, place): contents carry their first occurrence,
and a shard compares the first occurrences of the contents that hold a window.

Strings are matched by 64-bit hashes across shards and byte by byte within
them. Edge cases: null text is empty (0 bytes); texts under a window stay whole;
null ids and repeated rows are documents like others; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .store import written
from .text import Block, _string_buffers, blocks, byte_prefix, byte_range_hash, mix64, ranges, values

WINDOW, CORE = 400, 64
#: Windows per class of the finer keys.
CLASSES = (42, 1)
HOT_CONTENTS, SHARD_BYTES = 4_096, 1 << 20
#: Bytes handled at once, so that the arrays over them stay in a core's cache; longer documents are cut into overlapping pieces of so many window starts.
PIECE = 1 << 17


# ---------------------------------------------------------------- induced sorting

def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor (the final sentinel counts as such)."""
    n = len(t)
    rising = np.zeros(n, dtype=np.int8)
    rising[:-1] = np.where(t[:-1] < t[1:], 1, np.where(t[:-1] > t[1:], -1, 0))
    rising[-1] = 1
    # equal neighbours have the type of the next position that differs
    decided = np.where(rising != 0, np.arange(n), n)
    return rising[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def _by_symbol(positions: np.ndarray, symbols: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Appends positions, in order, to the list of their symbol."""
    if not len(positions):
        return
    order = np.argsort(symbols, kind="stable")
    positions, symbols = positions[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for part, c in zip(np.split(positions, cuts), symbols[np.concatenate([[0], cuts])].tolist()):
        into[c].append(part)


def _induce(t: np.ndarray, small: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Suffixes in the order induced by the leftmost-smaller positions ``starts`` (in their order)."""
    none = np.zeros(0, dtype=np.int64)
    seeds: list[list[np.ndarray]] = [[] for _ in range(k)]
    _by_symbol(starts, t[starts], seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(k)]
    placed: list[np.ndarray] = [none] * k
    for c in range(k):  # larger-type suffixes, buckets from the left
        wave, mine = (np.concatenate(larger[c]) if larger[c] else none), []
        while len(wave):
            mine.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            symbol = t[before]
            same = symbol == c
            _by_symbol(before[~same], symbol[~same], larger)
            wave = before[same]
        placed[c] = np.concatenate(mine) if mine else none
        if seeds[c]:
            seed = np.concatenate(seeds[c])
            before = seed[seed > 0] - 1
            _by_symbol(before, t[before], larger)
    smaller: list[list[np.ndarray]] = [[] for _ in range(k)]
    smaller[0].append(np.array([len(t) - 1]))
    out: list[np.ndarray] = []
    for c in range(k - 1, -1, -1):  # smaller-type suffixes, buckets from the right
        wave, mine = (np.concatenate(smaller[c]) if smaller[c] else none), []
        while len(wave):
            mine.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            symbol = t[before]
            same = symbol == c
            _by_symbol(before[~same], symbol[~same], smaller)
            wave = before[same]
        back = placed[c][::-1]
        before = back[back > 0] - 1
        before = before[small[before]]
        _by_symbol(before, t[before], smaller)
        out.extend(mine)
        out.append(back)
    return np.concatenate(out)[::-1]


def _names(t: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names (from 0) of the substrings t[p : ends[p] + 1] at the sorted positions ``order``."""
    a, b = order[:-1], order[1:]
    size = ends[a] - a
    same = size == ends[b] - b
    alive = np.flatnonzero(same)
    d = 0
    while len(alive):
        equal = t[a[alive] + d] == t[b[alive] + d]
        same[alive[~equal]] = False
        alive = alive[equal]
        alive = alive[size[alive] > d]
        d += 1
    return np.concatenate([[0], np.cumsum(~same)])


class _Inducer:
    """As ``_induce`` for a large alphabet, one suffix at a time over plain lists.

    ``larger[p]`` is the symbol before position p if the suffix there is of the
    larger type, else -1; ``smaller[p]`` likewise. Position n marks an empty slot.
    """

    def __init__(self, t: np.ndarray, small: np.ndarray, k: int):
        self.n = len(t)
        self.larger, self.smaller = (
            np.concatenate([[-1], np.where(small[:-1] == kind, t[:-1], -1), [-1]]).tolist() for kind in (False, True))
        self.ends = np.cumsum(np.bincount(t, minlength=k))
        self.t = t

    def __call__(self, starts: np.ndarray) -> np.ndarray:
        n, larger, smaller = self.n, self.larger, self.smaller
        # seeds at the tails of their buckets, in order
        bucket = self.t[starts]
        order = np.argsort(bucket, kind="stable")
        filled = np.full(n, n, dtype=np.int64)
        in_bucket = np.bincount(bucket, minlength=len(self.ends))
        filled[(self.ends - in_bucket)[bucket[order]] + ranges(in_bucket)] = starts[order]
        sa = filled.tolist()
        head = np.concatenate([[0], self.ends[:-1]]).tolist()
        for p in sa:  # grows to the right while it is read
            c = larger[p]
            if c >= 0:
                at = head[c]
                sa[at] = p - 1
                head[c] = at + 1
        tail = self.ends.tolist()
        for i in range(n - 1, -1, -1):
            p = sa[i]
            c = smaller[p]
            if c >= 0:
                tail[c] = at = tail[c] - 1
                sa[at] = p - 1
        return np.array(sa, dtype=np.int64)


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t`` (symbols below ``k``; the last, 0, occurs once) by induced sorting."""
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = (lambda starts: _induce(t, small, starts, k)) if k <= 1024 else _Inducer(t, small, k)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    order = induce(lms)
    order = order[is_lms[order]]
    ends = np.zeros(n, dtype=np.int64)
    ends[lms] = np.append(lms[1:], n - 1)
    names = _names(t, order, ends)
    reduced = np.empty(n, dtype=np.int64)
    reduced[order] = names
    reduced = reduced[lms]
    distinct = int(names[-1]) + 1
    if distinct < len(lms):
        order = lms[suffix_array(reduced, distinct)]
    return induce(order)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix of each suffix with its predecessor in the suffix array, that
    predecessor), both by text position.

    Only where the preceding symbols differ is a prefix measured; elsewhere it is
    one less than at the position before.
    """
    n = len(t)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    fresh = (before < 0) | (at == 0) | (before == 0)
    inner = np.flatnonzero(~fresh)
    fresh[inner] = t[inner - 1] != t[before[inner] - 1]
    common = np.zeros(n, dtype=np.int64)
    alive = np.flatnonzero(fresh & (before >= 0))
    length = np.zeros(len(alive), dtype=np.int64)
    live = np.arange(len(alive))
    while len(live):
        p, q = alive[live] + length[live], before[alive[live]] + length[live]
        inside = np.maximum(p, q) < n
        same = np.zeros(len(live), dtype=bool)
        same[inside] = t[p[inside]] == t[q[inside]]
        live = live[same]
        length[live] += 1
    common[alive] = length
    last = np.maximum.accumulate(np.where(fresh, at, 0))
    return np.maximum(common[last] - (at - last), 0), before


def _suffixes(contents: list[bytes], window: int):
    """(suffix array, common prefixes by position, predecessors, window starts by content back to back, their number)."""
    lengths = np.array([len(c) for c in contents])
    t = np.zeros(int(lengths.sum()) + len(contents) + 1, dtype=np.uint16)
    begins = np.cumsum(lengths + 1) - lengths - 1
    spot = np.repeat(begins, lengths) + ranges(lengths)
    t[spot] = np.frombuffer(b"".join(contents), dtype=np.uint8).astype(np.uint16) + 2
    t[begins + lengths] = 1
    sa = suffix_array(t, 258)
    common, before = permuted_common_prefixes(t, sa)
    starts = np.maximum(lengths - window + 1, 0)
    return sa, common, before, np.repeat(begins, starts) + ranges(starts), starts


def duplicate_windows(contents: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each content, a flag per window start: does its window start anywhere else in the contents?"""
    _, common, before, own, starts = _suffixes(contents, window)
    twice = np.zeros(len(common), dtype=bool)
    hit = own[common[own] >= window]
    twice[hit] = True
    twice[before[hit]] = True
    return np.split(twice[own], np.cumsum(starts)[:-1])


def later_windows(contents: list[bytes], firsts: list[tuple], window: int = WINDOW) -> list[np.ndarray]:
    """For each content, a flag per window start: does an earlier window of the contents equal it?

    ``firsts``: document (any orderable tuple) and place of each content's first occurrence.
    """
    sa, common, _, own, starts = _suffixes(contents, window)
    documents = {d: i for i, d in enumerate(sorted({f[0] for f in firsts}))}
    place = np.full(len(common), np.iinfo(np.int64).max)
    place[own] = (np.repeat([documents[f[0]] for f in firsts], starts).astype(np.int64) << 40) + np.repeat([f[1] for f in firsts], starts) + ranges(starts)
    # suffixes that share a window's length with their predecessor in the suffix array are of its group
    group = np.cumsum(common[sa] < window) - 1
    least = np.minimum.reduceat(place[sa], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
    later = np.zeros(len(common), dtype=bool)
    later[sa] = place[sa] > least[group]
    return np.split(later[own], np.cumsum(starts)[:-1])


# ---------------------------------------------------------------- stretches

def _pieces(batch: pa.RecordBatch, window: int) -> Iterator[tuple[Block, int]]:
    """Blocks of whole documents; a longer document comes in overlapping pieces with their offset."""
    for b in blocks(batch, "text", PIECE):
        if len(b.rows) > 1 or len(b.data) <= PIECE + window:
            yield b, 0
            continue
        for at in range(0, len(b.data) - window + 1, PIECE):
            data = b.data[at : at + PIECE + window - 1]
            yield Block(b.rows, data, np.array([0, len(data)])), at


class Stretches:
    """Stretches of a block: row, first window start (in the document), windows, key, content hash, level.

    ``finer`` holds a filter of keys per level that are dealt by classes of that level.
    """

    def __init__(self, block: Block, offset: int, finer: list[np.ndarray], window: int):
        data, offs = block.data, block.offsets
        self.data, self.window = data, window
        n = len(data)
        lengths = np.diff(offs)
        windows = np.maximum(lengths - window + 1, 0)
        empty = np.zeros(0, np.int64)
        self.row = self.start = self.begin = self.count = self.level = empty
        self.key = self.content = np.zeros(0, np.uint64)
        if not windows.any():
            return
        prefix = byte_prefix(data)
        smallest = self._minimizers(prefix, n, window)
        doc = np.repeat(np.arange(len(windows)), windows)
        start = np.repeat(offs[:-1], windows) + ranges(windows)
        core = smallest[start]
        new = np.concatenate([[True], (core[1:] != core[:-1]) | (doc[1:] != doc[:-1])])
        begin, core, doc = start[new], core[new], doc[new]
        count = np.diff(np.append(np.flatnonzero(new), len(start)))
        key = byte_range_hash(prefix, core, core + CORE)
        level = np.zeros(len(key), np.int64)
        for size, filter_words in zip(CLASSES, finer):
            begin, core, doc, count, key, level = self._finer(prefix, begin, core, doc, count, key, level, size, window, bloom.maybe(filter_words, key))
        self.row, self.start, self.begin, self.count, self.key, self.level = block.rows[doc], begin, begin - offs[doc] + offset, count, key, level
        self.content = byte_range_hash(prefix, begin, begin + count + (window - 1))

    @staticmethod
    def _minimizers(prefix: np.ndarray, n: int, window: int) -> np.ndarray:
        """Position of the smallest core hash among the cores of the window at each start."""
        span, m = window - CORE + 1, n - CORE + 1
        from .text import _BYTE_POWERS

        h = (prefix[CORE:] - prefix[:-CORE]) * _BYTE_POWERS.get(n + 1)[1][:m]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        # high bits of the hash, then the position, so that ties go to the left
        bits = np.uint64(23)
        h = (h >> bits << bits) | np.arange(m, dtype=np.uint64)
        full = -(-m // span) * span
        grid = np.full(full, np.uint64(0xFFFFFFFFFFFFFFFF))
        grid[:m] = h
        grid = grid.reshape(-1, span)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = m - span + 1
        return (np.minimum(back[:starts], ahead[span - 1 : span - 1 + starts]) & np.uint64((1 << 23) - 1)).astype(np.int64)

    @staticmethod
    def _finer(prefix, begin, core, doc, count, key, level, size, window, some):
        """The stretches ``some`` split into classes of ``size`` distances from the minimizer, keyed by the class's common core."""
        if not some.any():
            return begin, core, doc, count, key, level
        b, m, d, c = begin[some], core[some], doc[some], count[some]
        near, far = (m - b - c + 1) // size, (m - b) // size  # classes of the last and the first window
        classes = far - near + 1
        of = np.repeat(np.arange(len(b)), classes)
        low = m[of] - (far[of] - ranges(classes)) * size
        first = np.maximum(b[of], low - (size - 1))
        last = np.minimum(b[of] + c[of] - 1, low)
        new_key = mix64(byte_range_hash(prefix, low, low - (size - 1) + window) + np.uint64(size))
        keep = ~some
        return (np.concatenate([begin[keep], first]), np.concatenate([core[keep], m[of]]), np.concatenate([doc[keep], d[of]]),
                np.concatenate([count[keep], last - first + 1]), np.concatenate([key[keep], new_key]),
                np.concatenate([level[keep], level[some][of] + 1]))

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.count[i] + self.window - 1].tobytes()


def _counted(window: int):
    """key, content of every stretch."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, offset in _pieces(batch, window):
                s = Stretches(block, offset, [], window)
                yield pa.RecordBatch.from_arrays([pa.array(s.key.view(np.int64)), pa.array(s.content.view(np.int64))], ["key", "content"])
    return emit


def _listed(finer, repeated, window: int):
    """The stretches of crowded keys by class, and of the others those whose content is repeated."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, keys2 = batch.column("doc_id"), values(batch, "row"), values(batch, "row2")
            for block, offset in _pieces(batch, window):
                s = Stretches(block, offset, finer.value, window)
                some = np.flatnonzero((s.level > 0) | bloom.maybe(repeated.value, s.content))
                row = s.row[some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.key[some].view(np.int64)), pa.array(s.content[some].view(np.int64)), pa.array(s.level[some] > 0), ids.take(pa.array(row)).cast(pa.int64()),
                    pa.array(keys[row]), pa.array(keys2[row]), pa.array(s.begin[some].astype(np.int32)), pa.array(s.count[some].astype(np.int32))],
                    ["key", "content", "finer", "doc_id", "row", "row2", "begin", "count"])
    return emit


def _contents(finer, wanted, window: int):
    """key, content, bytes of the stretches whose content is wanted, once per batch."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for block, offset in _pieces(batch, window):
                s = Stretches(block, offset, finer.value, window)
                some = np.flatnonzero((s.level > 0) & bloom.maybe(wanted.value, s.content))
                if len(some):
                    _, first = np.unique(s.content[some], return_index=True)
                    some = [i for i in some[first].tolist() if int(s.content[i]) not in seen]
                    seen.update(s.content[some].tolist())
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.key[some].view(np.int64)), pa.array(s.content[some].view(np.int64)),
                    pa.array([s.bytes_of(i) for i in some], pa.binary())], ["key", "content", "bytes"])
    return emit


_BYTES = "key long, content long, bytes binary, none boolean, doc_id long, row long, row2 int, begin int"


def _shard(window: int, keep_first: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, content) -> content and runs of its duplicate (with ``keep_first``: later) windows.

    A shard's keys are taken together until SHARD_BYTES are held, whole keys at a time. With ``keep_first``
    a row without bytes comes before those of its content and names its first occurrence.
    """
    held: list[tuple[int, bytes, tuple]] = []
    size, key, last, first = 0, None, None, (None, None)

    def close() -> pa.RecordBatch:
        content, begin, count = [], [], []
        raw = [b for _, b, _ in held]
        flagged = (later_windows(raw, [f for *_, f in held], window) if keep_first else duplicate_windows(raw, window)) if held else []
        for (c, *_), flags in zip(held, flagged):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
            content += [c] * (len(edge) // 2)
            begin += edge[::2].tolist()
            count += (edge[1::2] - edge[::2]).tolist()
        return pa.RecordBatch.from_arrays([pa.array(content, pa.int64()), pa.array(begin, pa.int32()), pa.array(count, pa.int32())],
                                          ["content", "from", "windows"])

    for batch in batches:
        for k, c, raw, none, doc, r1, r2, at in zip(*(batch.column(n).to_pylist() for n in ("key", "content", "bytes", "none", "doc_id", "row", "row2", "begin"))):
            if raw is None:
                first = ((k, c), ((none, doc or 0, r1, r2), at))
                continue
            if (k, c) == last or (keep_first and first[0] != (k, c)):
                continue
            if k != key and size > SHARD_BYTES:
                yield close()
                held, size = [], 0
            held.append((c, raw, first[1]))
            size += len(raw)
            key, last = k, (k, c)
    yield close()


def duplicate_ranges(docs: DataFrame, window: int = WINDOW, keep_first: bool = False) -> DataFrame:
    """docs (doc_id, row, row2, text) -> doc_id, row, row2, runs: array of (begin, count) of duplicate window starts
    (with ``keep_first``: of those that an equal window precedes)."""
    sc = docs.sparkSession.sparkContext
    counted = docs.select("text").mapInArrow(_counted(window), "key long, content long")
    keys = counted.groupBy("key").agg(F.count("*").alias("times"), F.min("content").alias("content"), F.max("content").alias("other"))
    keys = written(keys.where("times > 1"), "suffix-keys")
    whole = keys.where("content = other").select("content")
    repeated = sc.broadcast(bloom.build(whole, "content"))
    filters = [bloom.build(keys.where("content <> other").select("key"), "key")]
    while True:
        finer = sc.broadcast(filters)
        listed = written(docs.mapInArrow(_listed(finer, repeated, window), "key long, content long, finer boolean, doc_id long, row long, row2 int, begin int, count int"), "suffix-stretches")
        place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "row2", "begin")
        contents = listed.groupBy("key", "content", "finer").agg(F.count("*").alias("times"), *([F.min(place).alias("first")] if keep_first else []))
        contents = written(contents.where("finer or times > 1"), "suffix-contents")
        crowded = written(contents.where("finer").groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-crowded")
        hot = crowded.where(F.col("kinds") > HOT_CONTENTS).select("key")
        if len(filters) == len(CLASSES) or hot.isEmpty():
            break
        filters.append(bloom.build(hot, "key"))
    shared = crowded.select(F.col("key").alias("shared_key"))
    mixed = contents.where("finer").join(shared, F.col("key") == F.col("shared_key"))
    mixed = written(mixed.select("key", "content", *(["first.*"] if keep_first else [])), "suffix-mixed")
    wanted = sc.broadcast(bloom.build(mixed.select("content"), "content"))
    raw = docs.mapInArrow(_contents(finer, wanted, window), "key long, content long, bytes binary")
    if keep_first:
        raw = raw.unionByName(mixed, allowMissingColumns=True)
    else:
        raw = raw.selectExpr("*", "cast(null AS boolean) AS none", "cast(null AS long) AS doc_id", "cast(null AS long) AS row", "cast(null AS int) AS row2", "cast(null AS int) AS begin")
    by_key = raw.repartition("key").sortWithinPartitions("key", "content", F.col("bytes").isNotNull())
    found = written(by_key.mapInArrow(partial(_shard, window, keep_first), "content long, from int, windows int"), "suffix-found")
    often = contents.where("times > 1").select(F.col("content").alias("c"), F.lit(0).alias("from"), F.lit(window).alias("windows"), *(["first"] if keep_first else []))
    found = found.withColumnRenamed("content", "c")
    if keep_first:
        # a repeated content goes everywhere but in its first place, the later windows of any content everywhere
        cut = often.unionByName(found.withColumn("first", F.lit(None).cast(often.schema["first"].dataType)))
    else:
        # a content met twice is duplicate throughout; of the others, the runs found in their shard
        once = contents.where("times = 1").select(F.col("content").alias("one"))
        cut = often.unionByName(found.join(once, F.col("c") == F.col("one"), "left_semi"))
    met = listed.join(cut, F.col("content") == F.col("c"))
    if keep_first:
        met = met.where(~F.coalesce(place.eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))
    run = F.struct((F.col("begin") + F.col("from")).alias("b"), F.least("windows", "count").alias("n"))
    return met.groupBy("doc_id", "row", "row2").agg(F.collect_list(run).alias("runs"))


def _strip(with_text: bool, window: int):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = _string_buffers(batch.column("text"))
            n_removed, n_spans, digests, texts = [], [], [], []
            for i, runs in enumerate(batch.column("runs")):
                own = data[offs[i] : offs[i + 1]]
                removed = spans = 0
                if runs.is_valid:
                    b, n = (runs.values.field(f).to_numpy() for f in (0, 1))
                    edge = np.zeros(len(own) + 1, dtype=np.int32)
                    np.add.at(edge, b, 1)
                    np.add.at(edge, b + n + window - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed, spans = int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    own = own[~gone]
                n_removed.append(removed)
                n_spans.append(spans)
                digests.append(hashlib.sha256(own).hexdigest())
                if with_text:
                    texts.append(own.tobytes().decode("utf-8", "ignore") if batch.column("text")[i].is_valid else None)
            out = [batch.column("doc_id"), pa.array(np.diff(offs)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                out += [pa.array(texts, pa.string()), batch.column("carried")]
                names += ["kept_text", "carried"]
            yield pa.RecordBatch.from_arrays(out, names)
    return strip


def deduplicate(docs: DataFrame, carry: list[str] | None = None, window: int = WINDOW, keep_first: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``carry`` also
    kept_text (partial characters at a cut are dropped) and a struct ``carried`` of those columns."""
    # rows that share an id (or have none) are told apart by 96 bits of two hashes of their text; equal rows fare alike
    keyed = docs.select("doc_id", F.xxhash64("text").alias("row"), F.hash("text").alias("row2"), "text", *([F.struct(*carry).alias("carried")] if carry else []))
    runs = duplicate_ranges(keyed.where(F.col("text").isNotNull()).select("doc_id", "row", "row2", "text"), window, keep_first)
    runs = runs.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), F.col("row2").alias("r2"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")) & (F.col("row2") == F.col("r2"))
    joined = keyed.join(runs, same, "left")
    joined = joined.select("doc_id", "text", "runs", *(["carried"] if carry else []))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if carry:
        schema += f", kept_text string, carried {joined.schema['carried'].dataType.simpleString()}"
    return joined.mapInArrow(_strip(bool(carry), window), schema)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
