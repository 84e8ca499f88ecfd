"""Operator 1's multi-index against all pairs, and the recall of its radius."""

import numpy as np

from cropflow.llm import decontaminate


def test_index_returns_every_fingerprint_within_the_radius(monkeypatch):
    rng = np.random.default_rng(1)
    held = rng.integers(0, 1 << 63, (300, 4), dtype=np.uint64)
    queries = held[rng.integers(0, 300, 500)].copy()
    for q in queries:  # turn up to 90 bits
        for bit in rng.choice(256, rng.integers(0, 91), replace=False):
            q[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    monkeypatch.setattr(decontaminate, "PROBE_WINDOWS", 64)
    got = set(zip(*(x.tolist() for x in decontaminate.BlockIndex(held).within(queries))))
    distance = np.bitwise_count(queries[:, None] ^ held[None]).sum(axis=2)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(distance <= decontaminate.RADIUS))))
    assert (np.bitwise_count(held[:, None] ^ held[None]).sum(axis=2) <= decontaminate.RADIUS).sum() == 300


def test_recall_of_similar_windows():
    rng = np.random.default_rng(2)
    near = total = 0
    for n in (10, 20, 36, 55):  # shingles of an item; windows that keep as many as 80 % similarity takes
        same = int(np.ceil(2 * 0.8 / 1.8 * n - 1e-9))
        for _ in range(500):
            item = rng.integers(1, 1 << 63, n, dtype=np.uint64)
            window = item.copy()
            window[rng.choice(n, n - same, replace=False)] = rng.integers(1, 1 << 63, n - same, dtype=np.uint64)
            a, b = (decontaminate.fingerprints(x, n)[0] for x in (item, window))
            near += int(np.bitwise_count(a ^ b).sum()) <= decontaminate.RADIUS
            total += 1
    assert near / total > 0.998
