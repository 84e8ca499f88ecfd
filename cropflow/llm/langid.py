"""Operator 5: language identification by rank-order n-gram profiles.

Each language's profile is the list of its most frequent character n-grams
(n = 1..3, words padded by a blank) in rank order. A document is profiled the
same way and gets the language with the smallest *out-of-place* distance: the
sum over the document's n-grams of |rank in document - rank in profile|, an
absent n-gram costing the profile size.

Letters are the alphabetic code points, lower-cased one by one; everything
else separates words. Letters that no profile uses count as one letter
"other" when a document is ranked. Ties in rank go by code point.

Plan: two map-side passes, no shuffle of text. Training counts n-grams of a
bounded, hash-chosen sample (``max_training_docs``, dealt over the languages) in Arrow batches,
sums them by (language, n-gram) and keeps ``profile_size`` rows per language;
these few rows (languages x profile size) are closed over by the scoring
pass, which reads whole texts.

Edge cases: a null text or one without letters gives ``und`` and score 0; no
labelled rows means every text gives ``und``; rows with a null language are
not learned from; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import Block, blocks, ranges

PROFILE_SIZE, MAX_TRAINING_DOCS, UNKNOWN = 400, 20_000, "und"
#: Bytes of text handled at once.
BLOCK = 1 << 18
#: Documents ranked together (bits of the sort key kept for the document).
_DOC_BITS = 10
_OTHER = 1  # letter 0 is the blank


@lru_cache(1)
def _lower_letters() -> np.ndarray:
    """Code point -> lower-case code point of letters, 0 for everything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0: separator) of the block and its document offsets in characters."""
    chars = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    lead = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=lead[1:])
    return _lower_letters()[chars], lead[block.offsets]


def _neighbours(letters: np.ndarray, offsets: np.ndarray):
    """(position, previous, own, next) of every letter; neighbours end at the document."""
    before, after = np.zeros_like(letters), np.zeros_like(letters)
    before[1:], after[:-1] = letters[:-1], letters[1:]
    begins, ends = offsets[:-1], offsets[1:]
    full = ends > begins
    before[begins[full]] = 0
    after[ends[full] - 1] = 0
    at = np.flatnonzero(letters)
    return at, before[at], letters[at], after[at]


def _grams(prev: np.ndarray, own: np.ndarray, nxt: np.ndarray, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the n-grams around each letter: 1-grams, 2-grams (letter and next),
    3-grams centred on it, and the leading 2-grams, whose letters ``lead`` picks."""
    two = own.dtype.type(1 << 3 * bits)
    b, bb = own.dtype.type(bits), own.dtype.type(2 * bits)
    lead = np.flatnonzero(prev == 0)
    return [own, two | (own << b) | nxt, (prev << bb) | (own << b) | nxt, two | own[lead]], lead


def _key_letters(key: int, bits: int) -> tuple[int, ...]:
    """The letters of an n-gram key, blank as 0."""
    mask = (1 << bits) - 1
    if key >> 3 * bits:
        return (key >> bits) & mask, key & mask
    if key >> bits:
        return (key >> 2 * bits) & mask, (key >> bits) & mask, key & mask
    return (key,)


_CODE_BITS = 20  # of a code point in a training key; alphabetic code points stay below 2**20


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for block in blocks(batch, "text", BLOCK):
            letters, offsets = _letters(block)
            at, prev, own, nxt = _neighbours(letters.astype(np.uint64), offsets)
            doc = np.searchsorted(offsets, at, side="right") - 1
            names = sorted({langs[r] for r in block.rows})
            of_row = np.array([names.index(langs[r]) for r in block.rows])
            of_letter = of_row[doc] if len(doc) else doc
            keys, lead = _grams(prev, own, nxt, _CODE_BITS)
            lang_of = [of_letter, of_letter, of_letter, of_letter[lead]]
            for i, name in enumerate(names):
                grams, counts = np.unique(np.concatenate([k[w == i] for k, w in zip(keys, lang_of)]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    ["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, profile_size: int = PROFILE_SIZE,
                   max_training_docs: int = MAX_TRAINING_DOCS) -> dict[str, list[int]]:
    """language -> n-gram keys in rank order, from about ``max_training_docs`` of the
    labelled rows (all, if fewer), an equal number of each language as far as it has them,
    chosen by a hash of ``doc_id`` and ``text``."""
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language, as the profiles themselves
    of_lang = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not of_lang:
        return {}
    left, most = max_training_docs, 0.0
    for k, n in enumerate(sorted(of_lang.values())):  # what small languages leave goes to larger ones
        most = left / (len(of_lang) - k)
        left -= min(n, most)
    limits = [(name, min(1 << 40, int(most / n * (1 << 40)) + 1)) for name, n in of_lang.items()]
    limits = labelled.sparkSession.createDataFrame(limits, "lang string, below long")
    # the list of languages is held by the driver as it is; the hint keeps texts from being shuffled for it
    chosen = labelled.select("lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("h")).join(
        F.broadcast(limits), "lang").where(F.col("h") < F.col("below"))
    counts = (chosen.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= profile_size).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda x: (x["lang"], x["r"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def _pack(letters: tuple[int, ...], bits: int) -> int:
    key = 0
    for c in letters:
        key = (key << bits) | c
    return key | (1 << 3 * bits if len(letters) == 2 else 0)


class _Scorer:
    """Profiles over a compact alphabet, ready to rank the documents of one task."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        split = {n: [_key_letters(g, _CODE_BITS) for g in profiles[n]] for n in self.names}
        used = sorted({c for grams in split.values() for g in grams for c in g if c})
        self.bits = (len(used) + 2).bit_length()
        self.kind = np.uint32 if 3 * self.bits + 1 + _DOC_BITS <= 32 else np.uint64
        self.letter = np.full(0x110000, _OTHER, dtype=self.kind)
        self.letter[0] = 0
        self.letter[used] = np.arange(_OTHER + 1, _OTHER + 1 + len(used))
        known: dict[int, list[int]] = {}
        for j, name in enumerate(self.names):
            for r, g in enumerate(split[name]):
                key = _pack(tuple(int(self.letter[c]) for c in g), self.bits)
                known.setdefault(key, [-1] * len(self.names))[j] = r
        self.known = np.array(sorted(known), dtype=np.int64)
        self.ranks = np.array([known[k] for k in sorted(known)], dtype=np.int64).reshape(len(known), len(self.names))

    def distances(self, letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents x languages out-of-place distances, n-grams ranked per document)."""
        docs = len(offsets) - 1
        gram_bits = 3 * self.bits + 1
        at, prev, own, nxt = _neighbours(self.letter[letters], offsets)
        doc = (np.searchsorted(offsets, at, side="right") - 1).astype(self.kind)
        keys, lead = _grams(prev, own, nxt, self.bits)
        high = doc << self.kind(gram_bits)
        keyed = np.concatenate([k | h for k, h in zip(keys, [high, high, high, high[lead]])])
        keyed.sort()
        first = np.flatnonzero(np.concatenate([[True], keyed[1:] != keyed[:-1]])) if len(keyed) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(keyed)))
        gram = (keyed[first] & self.kind((1 << gram_bits) - 1)).astype(np.int64)
        of_doc = (keyed[first] >> self.kind(gram_bits)).astype(np.int64)
        # most frequent first within a document, ties by key
        order = np.lexsort((gram, -counts, of_doc))
        gram, of_doc = gram[order], of_doc[order]
        distinct = np.bincount(of_doc, minlength=docs)
        rank = ranges(distinct)
        top = rank < self.size
        gram, of_doc, rank = gram[top], of_doc[top], rank[top]
        out = np.zeros((docs, len(self.names)), dtype=np.int64)
        if len(self.known) and len(gram):
            slot = np.minimum(np.searchsorted(self.known, gram), len(self.known) - 1)
            there = self.known[slot] == gram
            for j in range(len(self.names)):
                r = np.where(there, self.ranks[slot, j], -1)
                cost = np.where(r >= 0, np.abs(rank - r), self.size)
                out[:, j] = np.bincount(of_doc, weights=cost, minlength=docs).astype(np.int64)
        return out, np.minimum(distinct, self.size)


def _predict(profiles: dict[str, list[int]], size: int, keep: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(profiles, size)
        for batch in batches:
            best = np.full(batch.num_rows, UNKNOWN, dtype=object)
            score = np.zeros(batch.num_rows)
            for block in blocks(batch, "text", BLOCK) if scorer.names else ():
                letters, offsets = _letters(block)
                for i in range(0, len(block.rows), 1 << _DOC_BITS):
                    part = offsets[i : i + (1 << _DOC_BITS) + 1]
                    distance, ranked = scorer.distances(letters[part[0] : part[-1]], part - part[0])
                    some = ranked > 0
                    alike = 1 - distance / np.maximum(1, ranked * size)[:, None]
                    by = np.sort(alike, axis=1)[:, ::-1]
                    second = by[:, 1] if by.shape[1] > 1 else np.zeros(len(by))
                    rows = block.rows[i : i + len(ranked)]
                    best[rows] = np.where(some, np.array(scorer.names, dtype=object)[alike.argmax(axis=1)], UNKNOWN)
                    score[rows] = np.where(some, np.clip(by[:, 0] / np.maximum(by[:, 0] + second, 1e-12), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(best, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"])
    return predict


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: tuple[str, ...] = ("doc_id",),
             profile_size: int = PROFILE_SIZE) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred`` and ``score`` (share of the best
    language's similarity in that of the best two; 0 for ``und``)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    columns = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    return columns.mapInArrow(_predict(profiles, profile_size, list(keep)),
                              f"{schema}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 1 modulo 3 (never learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", held_out())
    profiles = learn_profiles(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(docs, profiles, keep=("doc_id", "held_out"))
