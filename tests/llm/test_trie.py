"""Operator 13 against dictionaries of whole prefixes, and DuckDB."""

import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropflow.llm import trie

from . import data
from .test_operators import _duck, _same

TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("depth", pa.string())])


def _plain(rows):
    said = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            said[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in said.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt = tuple(own.get(donor, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append((c, d == len(rebuilt)))
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            below[node[:d]][0] += node not in children
            below[node[:d]][1] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    return [{"conv_id": min(c for c, _ in m), "depth": len(node), "parent_conv_id": min(c for c, _ in members[node[:-1]]) if node else None,
             "n_convs": len(m), "n_children": children.get(node, 0), "n_leaves": below[node][0], "saved_tokens": below[node][1],
             "ends_sha256": hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest()} for node, m in members.items()]


def _rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), *range(200, 230), -1, -4, -5, -6, -13, 1_000_000_007]:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 11])):
            rows.append((c, turn * 3 - 2, rng.choice(["user", "system"]) if turn else "user", rng.choice(["hé", "ja", "no", "日本"]) if turn else "same start"))
    rows += [(300, t, "user", f"long {t % 7}") for t in range(70)] + [(301, 5 * t, "user", "x") for t in range(40)]
    rows += [(400, None, None, None), (400, None, "a", "b"), (400, 1, "a", None), (400, 1, "a", "b"), (400, 1, "a", "b"), (400, 1, "", "z"), (401, None, "q", "r")]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(c, t, "user", "copy") for c in range(500, 560) for t in range(4)]
    rng.shuffle(rows)
    return [(*r, "clash") for r in rows]


@pytest.mark.parametrize("options", [{}, {"shard_turns": 12, "messages": 2, "block": 8, "chunk": 60}, {"shard_turns": 1, "messages": 1, "block": 1, "chunk": 1}])
def test_trie_matches_plain_version(spark, options):
    rows = _rows()
    _same(trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string"), **options), _plain(rows))


@pytest.mark.parametrize("rows", [_rows(2), [], [(None, 1, "a", "b", "c")], [(3, None, None, None, None)]])
def test_query_matches_sql_and_plain_version(spark, rows):
    folder = data.fixture_folder([], conversations=(TURNS, rows))
    got = trie.op13_conversation_trie(spark, folder)
    _same(got, _plain(rows))
    _same(got, _duck(folder, trie.ORACLE_SQL, ["conversations"]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.none()), max_size=120), st.integers(1, 9))
def test_spilling_queue_is_a_priority_queue(steps, limit):
    queue, plain = trie.SpillingQueue(limit), []
    for s in steps:
        if s is None and plain:
            assert queue.peek() == min(plain)
            plain.remove(queue.pop())
        elif s is not None:
            queue.push((s,))
            plain.append((s,))
    assert [queue.pop() for _ in plain] == sorted(plain)
    assert queue.peek() is None
