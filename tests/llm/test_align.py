"""Operator 12 against one text at a time, whole texts encoded and links found by comparing ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cropflow.llm import align

from . import data

SCHEMA = "doc_id long, text string, n_a string"


def _plain(rows):
    a = Tokenizer.from_file(f"{align.FOLDER}/{align.FILE_A}")
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=f"{align.FOLDER}/{align.FILE_B}")
    chars = align._byte_of_char()
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            docs.append((doc_id, 0, 0, 0, "", []))
            continue
        spans = []
        for pieces in (bytes_a, bytes_b):
            ends = np.cumsum([len(p) for p in pieces]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for c in common:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, sp) if last < e <= c) for ids, sp in zip((ids_a, ids_b), spans)))
            last = c
        links, j = [], 0
        for x, (s, e) in zip(ids_a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(ids_b) and spans[1][k][0] < e:
                links.append((x, ids_b[k]))
                k += 1
        pairs.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    return sorted(((d, na, nb, ng, len(ls), sum(pairs[p] == most[p[1]] for p in ls), sum(pairs[p] for p in ls), h) for d, na, nb, ng, h, ls in docs), key=str)


def _rows():
    odd = ["a  b", "  lead", "trail ", "tab\tand\nline \n x", "▁under▁", "▁", "x ▁ y", "<|endoftext|> <s> </s> <unk> <0x41>", "I'll you've 'S don't",
           "日本語 テキスト 🙂🙂 é́", "nul\x00in side", "a b   c", "﻿bom", "\x1c \x1f x", "1234567890 12 3,4", "ab" * 3000, " " * 500 + "x", "🙂" * 300, "ﬁ ligature ①"]
    rows = [(r[0], r[1]) for r in data.documents(seed=9, n=20)] + [(1000 + i, t) for i, t in enumerate(odd)]
    return rows + [(None, "same words here"), (None, "same words here")]


@pytest.mark.parametrize("pair_limit", [align.PAIR_LIMIT, 10])
def test_alignment_matches_plain_version(spark, pair_limit):
    rows = _rows()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    got = align.alignment(docs, pair_limit=pair_limit).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == _plain(rows)


@pytest.mark.parametrize("pair_limit", [align.PAIR_LIMIT, -1])
def test_empty_table(spark, pair_limit):
    assert align.alignment(spark.createDataFrame([], SCHEMA), pair_limit=pair_limit).collect() == []


def test_query_on_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = align.op12_token_alignment(spark, folder).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == _plain(rows)


def test_cache_of_words_may_overflow(monkeypatch):
    monkeypatch.setattr(align, "CACHE_WORDS", 5)
    small, large = (align.Encoder(align.vocabulary_files()) for _ in (0, 1))
    rng = random.Random(3)
    for _ in range(5):
        texts = [" ".join(rng.choice(["red", "green", "b lue", "x\ny", ""]) for _ in range(9)) for _ in range(4)]
        large._reset()
        for x, y in zip(small.encode(texts)[0], large.encode(texts)[0]):
            assert x.tolist() == y.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60), max_size=25), st.sets(st.integers(1, 60), max_size=25)), max_size=6))
def test_galloping_finds_common_ends_and_overlaps(texts):
    ends = [[sorted(s | {61}) for s in t] for t in texts]
    flat = [np.array([e for t in ends for e in t[s]], dtype=np.int64) for s in (0, 1)]
    counts = [np.array([len(t[s]) for t in ends], dtype=np.int64) for s in (0, 1)]
    al = align.align(*flat, *counts)
    links, commons, base = [], [], [0, 0]
    for a, b in ends:
        for i, (s, e) in enumerate(zip([0, *a], a)):
            links += [(base[0] + i, base[1] + j) for j, (p, q) in enumerate(zip([0, *b], b)) if s < q and p < e]
            commons += [e in b]
        base = [base[0] + len(a), base[1] + len(b)]
    assert sorted(zip(al.link_a.tolist(), al.link_b.tolist())) == links
    assert al.common_a.tolist() == commons
    assert int(al.common_b.sum()) == sum(commons)
