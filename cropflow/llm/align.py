"""Operator 12: alignment of two tokenizers' tokens by byte offsets.

Each text is encoded twice, space + text by a byte-level BPE (A) and the text
by a sentence-piece BPE that adds that space (B). The ascending lists of byte
offsets where tokens end are intersected by galloping: the shorter list drives
an exponential search, then a binary search, into the longer. Common offsets
slice the tokens into groups; the difference of the ranks found for two
neighbours is the range of tokens that overlap one, hence the links.

1. One map over whole texts encodes, aligns and writes, per document, its
   counts, the digest of its groups and its distinct linked id pairs with their
   number; a row per block of texts holds the block's sums over pairs.
2. Pair counts of the corpus are those rows' sums (one row a pair and task is
   shuffled).
3. Documents look up their pairs. A pair table of at most ``pair_limit`` rows is
   broadcast; a larger one is joined on the pair (Spark splits a hot pair).

Encoding. Neither tokenizer has a token that spans a single space between two
non-spaces with text on both sides of it (A by its pattern; for B the
vocabulary is examined, and whole texts are encoded if it has such a piece), so
the distinct words between such spaces are encoded once per block. Texts are
decoded to bytes again and compared.

Edge cases: texts null, empty, not UTF-8, or whose tokens give other bytes than
space + text have no tokens: zeros and an empty digest column. Null and
repeated ids stay rows of their own; an empty table gives no rows; other
columns are ignored. A text is handled whole: memory follows the longest text
(about 100 times its bytes).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import written
from .text import _string_buffers, ranges

#: Folder of the vocabulary files (a parameter of every function that reads them).
FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs that may be broadcast (16 bytes each).
PAIR_LIMIT = 4_000_000
BLOCK_BYTES = 2 << 20
#: Words whose tokens a task keeps between blocks.
CACHE_WORDS = 1 << 18

_ONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


# ---------------------------------------------------------------- tokenizers

def vocabulary_files(folder: str = FOLDER) -> tuple[bytes, bytes]:
    """The two vocabulary files; about 2 MB, read by the driver and broadcast."""
    out = []
    for name in (FILE_A, FILE_B):
        with open(f"{folder}/{name}", "rb") as f:
            out.append(f.read())
    return out[0], out[1]


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """A: ids of space + word, and the bytes of each id."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks, not threads, share the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(raw.decode())
        self._tokenizer.encode_special_tokens = True
        spec, alphabet = json.loads(raw), _byte_of_char()
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.pieces = [bytes(alphabet[c] for c in names[i]) if i in names and all(c in alphabet for c in names[i]) else b""
                       for i in range(max(names) + 1)]

    def __call__(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]


class PieceTokenizer:
    """B: ids of a word (the tokenizer adds the space), and the bytes of each id."""

    def __init__(self, raw: bytes):
        from sentencepiece import SentencePieceProcessor

        self._processor = p = SentencePieceProcessor(model_proto=raw)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.pieces = [bytes([int(n[3:5], 16)]) if p.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.by_word = not any("▁" in n.lstrip("▁") for n in names)

    def __call__(self, words: list[str]) -> list[list[int]]:
        return self._processor.encode(words, num_threads=1)


class _Ids:
    """Token ids of words, back to back."""

    def __init__(self, lists: list[list[int]], pieces: list[bytes], words: list[str]):
        self.count = np.fromiter(map(len, lists), np.int64, len(lists))
        self.flat = np.fromiter((i for ids in lists for i in ids), np.int64, int(self.count.sum()))
        self.fits = np.array([b"".join([pieces[i] for i in ids]) == b" " + w.encode() for ids, w in zip(lists, words)], dtype=bool)


class Encoder:
    """Texts to token ids of both tokenizers, words encoded once."""

    def __init__(self, files: tuple[bytes, bytes]):
        self.a, self.b = ByteTokenizer(files[0]), PieceTokenizer(files[1])
        self.size = [np.array([len(p) for p in t.pieces]) for t in (self.a, self.b)]
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.flat, self.begin, self.count, self.fits = [none, none], [none, none], [none, none], np.zeros(0, bool)

    def words(self, text: str) -> list[str]:
        words = _ONE_SPACE.split(" " + text) if self.b.by_word else [" " + text]
        words[0] = words[0][1:]
        return words

    def _learn(self, words: list[str]) -> None:
        for w in words:
            self.known[w] = len(self.known)
        for side, tokenizer in enumerate((self.a, self.b)):
            new = _Ids(tokenizer(words), tokenizer.pieces, words)
            ends = np.cumsum(new.count) + len(self.flat[side])
            self.begin[side] = np.concatenate([self.begin[side], ends - new.count])
            self.count[side] = np.concatenate([self.count[side], new.count])
            self.flat[side] = np.concatenate([self.flat[side], new.flat])
            fits = new.fits if side == 0 else fits & new.fits
        self.fits = np.concatenate([self.fits, fits])

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Token ids and their number per text, for A and B, and whether the text has tokens.

        Ids are back to back and hold only texts with tokens.
        """
        if len(self.known) > CACHE_WORDS:
            self._reset()
        parts = [self.words(t) if t else [] for t in texts]
        fresh = {w for p in parts for w in p if w not in self.known}
        if fresh:
            self._learn(list(fresh))
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        word = np.fromiter((self.known[w] for p in parts for w in p), np.int64, int(size.sum()))
        text = np.repeat(np.arange(len(parts)), size)
        good = size > 0
        for t in set(text[~self.fits[word]].tolist()):  # words differ; do the whole texts?
            own = word[text == t]
            want = b" " + texts[t].encode()
            good[t] = all(b"".join([tok.pieces[i] for w in own for i in self.flat[s][self.begin[s][w] : self.begin[s][w] + self.count[s][w]].tolist()]) == want
                          for s, tok in enumerate((self.a, self.b)))
        keep = good[text]
        word, text = word[keep], text[keep]
        ids, counts = [], []
        for s in (0, 1):
            n = self.count[s][word]
            ids.append(self.flat[s][np.repeat(self.begin[s][word], n) + ranges(n)])
            counts.append(np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64))
        return ids, counts, good


# ---------------------------------------------------------------- galloping intersection

def gallop(needles: np.ndarray, hay: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each needle the first place in hay[low:high] (ascending) with a value not below it, else high.

    Every search doubles its step away from ``start`` until it has passed the
    needle and halves the last step then; all needles step together.
    """
    at = np.clip(start, low, high - 1)
    below = hay[at] < needles
    floor, ceiling = np.where(below, at, low - 1), np.where(below, high, at)
    for up in (True, False):
        live, step = np.flatnonzero(below if up else ~below), 1
        while len(live):
            probe = floor[live] + step if up else ceiling[live] - step
            inside = probe < high[live] if up else probe >= low[live]
            live, probe = live[inside], probe[inside]
            smaller = hay[probe] < needles[live]
            floor[live[smaller]] = probe[smaller]
            ceiling[live[~smaller]] = probe[~smaller]
            live = live[smaller if up else ~smaller]
            step *= 2
    live = np.flatnonzero(ceiling - floor > 1)
    while len(live):
        middle = (floor[live] + ceiling[live]) >> 1
        smaller = hay[middle] < needles[live]
        floor[live[smaller]] = middle[smaller]
        ceiling[live[~smaller]] = middle[~smaller]
        live = live[ceiling[live] - floor[live] > 1]
    return ceiling


class Aligned(NamedTuple):
    """Links (indexes of A and B tokens) and, per token, whether its end is common."""

    link_a: np.ndarray
    link_b: np.ndarray
    common_a: np.ndarray
    common_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> Aligned:
    """Token ends of several texts back to back (ascending per text), with their number per text."""
    common = [np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)]
    ends, counts = (ends_a, ends_b), (count_a, count_b)
    first = [np.cumsum(c) - c for c in counts]
    links: list[list[np.ndarray]] = [[], []]
    for short, texts in ((0, np.flatnonzero(count_a <= count_b)), (1, np.flatnonzero(count_a > count_b))):
        long = 1 - short
        n, m = counts[short][texts], counts[long][texts]
        own = ranges(n)
        token = np.repeat(first[short][texts], n) + own
        low = np.repeat(first[long][texts], n)
        rank = gallop(ends[short][token], ends[long], low, low + np.repeat(m, n), low + own * np.repeat(m, n) // np.maximum(np.repeat(n, n), 1))
        met = ends[long][rank] == ends[short][token]
        common[short][token] = met
        common[long][rank[met]] = True
        before = np.concatenate([[0], (rank + met)[:-1]]) if len(rank) else rank
        before = np.where(own == 0, low, before)
        overlap = rank - before + 1
        links[short].append(np.repeat(token, overlap))
        links[long].append(np.repeat(before, overlap) + ranges(overlap))
    return Aligned(np.concatenate(links[0]), np.concatenate(links[1]), *common)


class GroupText:
    """``a1,a2|b1;a3|b2,b3`` of the groups of a text."""

    def __init__(self, size_a: int, size_b: int):
        a, b = [str(i) for i in range(size_a)], [str(i) for i in range(size_b)]
        self.parts = [*("," + x for x in a), *(";" + x for x in a), *a, *("," + x for x in b), *("|" + x for x in b)]
        self.a, self.b = size_a, size_b

    def __call__(self, ids: list[np.ndarray], counts: list[np.ndarray], al: Aligned) -> list[str]:
        group_a, group_b = (np.cumsum(c) - c for c in (al.common_a, al.common_b))
        groups = int(al.common_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        new_a, new_b = (np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
        opens = np.zeros(len(ids[0]), bool)
        opens[(np.cumsum(counts[0]) - counts[0])[counts[0] > 0]] = True
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        codes[np.arange(len(ids[0])) + (np.cumsum(in_b) - in_b)[group_a]] = ids[0] + np.where(opens, 2, np.where(new_a, 1, 0)) * self.a
        codes[np.arange(len(ids[1])) + np.cumsum(in_a)[group_b]] = ids[1] + 3 * self.a + new_b * self.b
        parts, out, at = self.parts, [], 0
        for n in (counts[0] + counts[1]).tolist():
            out.append("".join([parts[c] for c in codes[at : at + n].tolist()]))
            at += n
        return out


# ---------------------------------------------------------------- tasks

def _texts(column: pa.Array) -> list[str | None]:
    """Strings; None where null, empty or not UTF-8."""
    try:
        return [t or None for t in column.to_pylist()]
    except UnicodeDecodeError:
        raw = column.cast(pa.binary()).to_pylist()
        return [t.decode() if t and t.decode("utf-8", "replace").encode() == t else None for t in raw]


def _cuts(column: pa.Array) -> list[tuple[int, int]]:
    _, offs = _string_buffers(column)
    out, i = [], 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK_BYTES, side="right")) - 1)
        out.append((i, j))
        i = j
    return out


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, sums boolean"


def _linked(files):
    """A row per text with its distinct linked pairs, and a row of sums (true) per block."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(files.value)
        text_of = GroupText(len(encoder.a.pieces), len(encoder.b.pieces))
        width = len(encoder.b.pieces)
        names = [f.split()[0] for f in _DOCUMENT.split(", ")]
        for batch in batches:
            for i, j in _cuts(batch.column("text")):
                part = batch.slice(i, j - i)
                ids, counts, good = encoder.encode(_texts(part.column("text")))
                al = align(*(_ends(encoder.size[s][ids[s]], counts[s]) for s in (0, 1)), *counts)
                doc = np.repeat(np.arange(j - i), counts[0])
                key = ids[0][al.link_a] * width + ids[1][al.link_b]
                span = len(encoder.a.pieces) * width
                mixed, times = np.unique(doc[al.link_a] * span + key, return_counts=True)
                owner, pair = mixed // span, mixed % span
                cut = np.searchsorted(owner, np.arange(j - i + 1))
                digests = [hashlib.sha256(t.encode()).hexdigest() if g else "" for t, g in zip(text_of(ids, counts, al), good)]
                total, where = np.unique(pair, return_inverse=True)
                sums = np.zeros(len(total), np.int64)
                np.add.at(sums, where, times)
                raw = lambda x: [x[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                n_groups = np.bincount(doc, weights=al.common_a, minlength=j - i).astype(np.int64)
                n_links = np.bincount(owner, weights=times, minlength=j - i).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([part.column("doc_id").cast(pa.int64()), pa.nulls(1, pa.int64())]),
                    *(pa.array(np.append(x, 0)) for x in (*counts, n_groups, n_links)), pa.array([*digests, ""]),
                    pa.array([*raw(pair), total.tobytes()], pa.binary()), pa.array([*raw(times.astype(np.int32)), sums.tobytes()], pa.binary()),
                    pa.array([False] * (j - i) + [True])], names)
    return emit


def _ends(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """End offsets in each text, from token lengths back to back."""
    total = np.cumsum(sizes)
    first = np.cumsum(counts) - counts
    base = np.concatenate([[0], total])[first]
    return total - np.repeat(base, counts)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pairs and numbers from the packed columns."""
    for batch in batches:
        size = 4 if "row" in batch.schema.names else 8
        for k in range(batch.num_rows):
            pair = np.frombuffer(batch.column("pairs")[k].as_buffer(), np.int64)
            times = np.frombuffer(batch.column("times")[k].as_buffer(), np.int32 if size == 4 else np.int64).astype(np.int64)
            columns = [pa.array(pair), pa.array(times)]
            if size == 4:
                columns.append(pa.array(np.full(len(pair), batch.column("row")[k].as_py())))
            yield pa.RecordBatch.from_arrays(columns, ["pair", "times", "row"][: len(columns)])


def _scored(table):
    """n_best and count_sum of each text from the broadcast pair table."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = table.value
        for batch in batches:
            own, offs = _string_buffers(batch.column("pairs"))
            numbers, _ = _string_buffers(batch.column("times"))
            n = np.frombuffer(numbers.tobytes(), np.int32).astype(np.int64)
            at = np.searchsorted(pair, np.frombuffer(own.tobytes(), np.int64))
            results = []
            for value in (n * best[at], n * count[at]):
                total = np.concatenate([[0], np.cumsum(value)])
                results.append(pa.array(total[offs[1:] // 8] - total[offs[:-1] // 8]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in _COUNTS] + results, [*_COUNTS, "n_best", "count_sum"])
    return emit


_COUNTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def alignment(docs: DataFrame, folder: str = FOLDER, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    sc = docs.sparkSession.sparkContext
    raw = vocabulary_files(folder)
    linked = docs.select("doc_id", "text").mapInArrow(_linked(sc.broadcast(raw)), _DOCUMENT)
    linked = written(linked.withColumn("row", F.monotonically_increasing_id()), "align-links")
    texts = linked.where("not sums")
    counted = linked.where("sums").select("pairs", "times").mapInArrow(_pairs, "pair long, times long")
    counted = written(counted.groupBy("pair").agg(F.sum("times").alias("count")), "align-pairs")
    width = len(PieceTokenizer(raw[1]).pieces)
    if counted.count() <= pair_limit:
        table = counted.toArrow()
        pair, count = (table.column(c).to_numpy() for c in ("pair", "count"))
        order = np.argsort(pair)
        pair, count = pair[order], count[order]
        most = np.zeros(width, np.int64)
        np.maximum.at(most, pair % width, count)
        found = sc.broadcast((pair, count, (count == most[pair % width]).astype(np.int64)))
        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
        return texts.select(*_COUNTS, "pairs", "times").mapInArrow(_scored(found), schema)
    b = F.col("pair") % width
    most = counted.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    known = counted.withColumn("b", b).join(most, "b").select(F.col("pair").alias("known"), "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    each = texts.select("pairs", "times", "row").mapInArrow(_pairs, "pair long, times long, row long")
    sums = each.join(known, F.col("pair") == F.col("known")).groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return texts.join(sums, F.col("row") == F.col("r"), "left").select(
        *_COUNTS, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
