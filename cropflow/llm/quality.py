"""Operator 10: quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its words and of the byte
3- and 4-grams inside its words (a word's neighbouring blank counts as a
byte), all hashed into ``2**BUCKET_BITS`` buckets; two more buckets stand for a
word that the document has used before and for a word that follows itself. A
linear layer and softmax give the label probabilities. Vectors and layer are trained together by
stochastic gradient descent in numpy.

Because the average is linear, a document's logits are the mean over its
features of (vector of the bucket . layer): scoring needs one table of
bucket x label numbers, looked up per feature of the whole text.

Plan: about ``MAX_TRAINING_DOCS`` labelled rows, chosen by a hash of the id, are
broadcast to the documents; the features of their whole texts are counted on
the executors and the sparse rows trained on the driver (bounded by the
sample). The scoring pass is one map over whole texts with no shuffle.

Edge cases: a null or blank text has no features and gets the bias alone;
labels that are null are not learned from; two different labels of one document are
two training rows, a repeated label is one; with labelled rows of one class only the model is a
constant close to that class (0.5 without any); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import held_out
from .text import _SPACE, Block, blocks, mix64, word_bounds, word_hashes

#: Buckets of the two repetition features (hashed features may share them).
USED_BEFORE, FOLLOWS_ITSELF = 0, 1
BUCKET_BITS, DIMENSIONS, EPOCHS, RATE, MAX_TRAINING_DOCS, SEED = 17, 8, 6, 1.0, 6_000, 7


def _features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature, document index of it), documents in order within each kind."""
    starts, ends, first = word_bounds(block)
    shift = np.uint64(64 - BUCKET_BITS)
    words = word_hashes(block.data, starts, ends)
    buckets = [(words >> shift).astype(np.int32)]
    doc = [np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))]
    own = words + mix64(doc[0].astype(np.uint64) + np.uint64(1))  # a word of one document
    used = np.ones(len(words), dtype=bool)
    used[np.unique(own, return_index=True)[1]] = False
    follows = np.flatnonzero(own[1:] == own[:-1]) + 1
    for bucket, at in ((USED_BEFORE, np.flatnonzero(used)), (FOLLOWS_ITSELF, follows)):
        buckets.append(np.full(len(at), bucket, dtype=np.int32))
        doc.append(doc[0][at])
    text = block.data.astype(np.uint32)
    inside = ~_SPACE[block.data]
    row = np.repeat(np.arange(len(block.rows), dtype=np.int32), np.diff(block.offsets))
    for n in (3, 4):
        if len(text) < n:
            continue
        m = len(text) - n + 1
        ok = row[:m] == row[n - 1 :]
        for j in range(1, n - 1):
            ok &= inside[j : j + m]
        at = np.flatnonzero(ok)
        gram = np.zeros(len(at), dtype=np.uint32)
        for j in range(n):
            gram = (gram << np.uint32(8)) | text[at + j]
        # 32-bit multiplicative hashing; the odd constant differs by n
        buckets.append(((gram * np.uint32(0x9E3779B1 if n == 3 else 0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
        doc.append(row[at])
    return np.concatenate(buckets), np.concatenate(doc)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse feature rows: doc_id, label, bucket ids (int32 bytes), counts (int32 bytes)."""
    for batch in batches:
        ids, labels, b, c = [], [], [], []
        for block in blocks(batch, "text"):
            bucket, doc = _features(block)
            keys, counts = np.unique(doc.astype(np.int64) << BUCKET_BITS | bucket, return_counts=True)
            cut = np.searchsorted(keys >> BUCKET_BITS, np.arange(len(block.rows) + 1))
            for i, row in enumerate(block.rows):
                part = slice(cut[i], cut[i + 1])
                ids.append(row)
                b.append((keys[part] & ((1 << BUCKET_BITS) - 1)).astype(np.int32).tobytes())
                c.append(counts[part].astype(np.int32).tobytes())
        rows = pa.array(ids, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("label").take(rows), pa.array(b, pa.binary()), pa.array(c, pa.binary())],
            ["doc_id", "label", "buckets", "counts"])


def train(rows: pd.DataFrame) -> np.ndarray:
    """Margin of every bucket (logit of label 1 minus that of label 0), and the bias last.

    Each step takes one document: vectors of its buckets and the layer move
    along the gradient of its cross-entropy; the rate falls linearly to 0.
    """
    table = np.zeros((1 << BUCKET_BITS) + 1, dtype=np.float64)
    y = rows["label"].to_numpy()
    ones = int((y == 1).sum())
    if not 0 < ones < len(y):
        table[-1] = 0.0 if not len(y) else (8.0 if ones else -8.0)
        return table
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS))
    layer = np.zeros((2, DIMENSIONS))
    bias = np.log(np.array([len(y) - ones, ones]) / len(y))
    docs = []
    for b, c in zip(rows["buckets"], rows["counts"]):
        n = np.frombuffer(c, np.int32).astype(np.float64)
        docs.append((np.frombuffer(b, np.int32), n / max(1.0, n.sum())))
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rate = RATE * (1 - done / steps)
            done += 1
            b, w = docs[i]
            mine = vectors[b]
            x = w @ mine
            z = layer @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            back = layer.T @ p
            layer -= rate * p[:, None] * x[None, :]
            bias -= rate * 0.1 * p
            # a bucket's own share of the average times a constant keeps rare features learnable
            vectors[b] = mine - (rate * len(b)) * w[:, None] * back[None, :] / max(1.0, np.sqrt(len(b)))
    table[:-1] = vectors @ (layer[1] - layer[0])
    table[-1] = bias[1] - bias[0]
    return table


def learn(docs: DataFrame, labels: DataFrame, max_training_docs: int = MAX_TRAINING_DOCS) -> np.ndarray:
    """Train on about ``max_training_docs`` of the different ``labels`` rows (doc_id, label), chosen by a
    hash of ``doc_id``, which has two at most; so few are broadcast, and texts are not shuffled."""
    labels = labels.where(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    share = min(1.0, max_training_docs / max(1, labels.count()))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(_count, f"doc_id {kind}, label int, buckets binary, counts binary").toPandas()
    return train(rows.sort_values(["doc_id", "label"], kind="stable").reset_index(drop=True))


def _apply(table: np.ndarray, keep: list[str]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias = table[:-1].astype(np.float64), table[-1]
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for block in blocks(batch, "text"):
                bucket, doc = _features(block)
                n = np.bincount(doc, minlength=len(block.rows))
                total = np.bincount(doc, weights=margin[bucket], minlength=len(block.rows))
                score[block.rows] = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"])
    return apply


def score(docs: DataFrame, table: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(_apply(table, list(keep)), f"{schema}, score double, predicted int")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", held_out())
    labels = (spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out() & F.col("quality").isNotNull())
              .select("doc_id", F.col("quality").alias("label")))
    table = learn(docs, labels)
    return score(docs, table, keep=("doc_id", "held_out"))
