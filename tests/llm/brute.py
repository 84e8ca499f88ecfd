"""Plain, quadratic versions of the operators to test against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode()) if text else []


def suffix_dedup(rows: list[tuple], window: int = 400) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + window] for _, b in raw for s in range(len(b) - window + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if seen[b[s : s + window]] > 1:
                gone[s : s + window] = [True] * window
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def signed_hash(text: str | None) -> int:
    """Spark's xxhash64 of a string."""
    h = xxhash.xxh64((text or "").encode(), seed=42).intdigest() if text is not None else 42
    return h - (1 << 64) if h >> 63 else h


def later_strings(rows: list[tuple], window: int) -> list[tuple]:
    """(doc_id, kept bytes) where of equal strings the first by (doc_id, none last, text hash, place) stays."""
    raw = [((i is None, i or 0, signed_hash(t)), (t or "").encode()) for i, t in rows]
    least: dict = {}
    for key, b in raw:
        for s in range(len(b) - window + 1):
            place = (key, s)
            w = b[s : s + window]
            if w not in least or place < least[w]:
                least[w] = place
    out = []
    for (i, _), (key, b) in zip(rows, raw):
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if least[b[s : s + window]] < (key, s):
                gone[s : s + window] = [True] * window
        out.append((i, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def substring_dedup(rows: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    split = [(i, words(t)) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, w in split:
        if i is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s : s + window])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        if i is not None:
            for s in range(len(w) - window + 1):
                if least[tuple(w[s : s + window])] < i:
                    gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text: str | None) -> frozenset:
    w = [x.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id)."""
    sets = [(i, shingles(t)) for i, t in rows]
    near: dict[int, set[int]] = defaultdict(set)
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                near[i].add(j)
    root: dict[int, int] = {}
    for i in sorted(near):
        if i not in root:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = i
                    todo += near[x]
    return [(i, len(s), root.get(i, i)) for i, s in sets]


def leaks(docs: list[tuple], items: list[tuple], least: float = 0.8) -> dict[tuple, float]:
    """(doc_id, item_id) -> best weighted similarity of an item-sized window, where it reaches ``least``."""
    def grams(w):
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    low = lambda t: [x.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for x in words(t)]
    out: dict[tuple, float] = {}
    for item, text in items:
        own = low(text)
        if not own:
            continue
        if len(own) < 5:  # one shingle, all of it
            for doc, body in docs:
                w = low(body)
                if any(w[s : s + len(own)] == own for s in range(len(w) - len(own) + 1)):
                    out[doc, item] = 1.0
            continue
        have = Counter(grams(own))
        for doc, body in docs:
            w = low(body)
            for s in range(len(w) - len(own) + 1):
                there = Counter(grams(w[s : s + len(own)]))
                if not there.keys() & have.keys():
                    continue
                similarity = sum((there & have).values()) / sum((there | have).values())
                if similarity >= least and similarity > out.get((doc, item), 0):
                    out[doc, item] = similarity
    return out


def language(train: list[tuple], texts: list, profile_size: int = 400) -> list[tuple[str, float]]:
    """(language, score) of every text by out-of-place distance; train: (text, lang)."""
    def letters(text):
        return [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "" for c in text]

    def grams(text):
        c = ["", *letters(text), ""]
        for p, own, n in zip(c, c[1:], c[2:]):
            if own:
                yield from ((0, own), (2, own, n), (1, p, own, n))
                if not p:
                    yield (2, "", own)

    def ranked(counts, order):
        return sorted(counts, key=lambda g: (-counts[g], order(g)))[:profile_size]

    def by_code(g):
        return (g[0], *(ord(c) if c else 0 for c in g[1:]))

    seen: dict = defaultdict(Counter)
    for text, lang in train:
        seen[lang].update(grams(text))
    profiles = {lang: {g: r for r, g in enumerate(ranked(c, by_code))} for lang, c in sorted(seen.items())}
    used = {c for p in profiles.values() for g in p for c in g[1:] if c}
    out = []
    for text in texts:
        own = Counter((g[0], *(c if not c or c in used else "?" for c in g[1:])) for g in grams(text or ""))
        top = ranked(own, lambda g: (g[0], *(0 if not c else 1 if c == "?" else 2 + ord(c) for c in g[1:])))
        if not top or not profiles:
            out.append(("und", 0.0))
            continue
        alike = {lang: 1 - sum(abs(r - p[g]) if g in p else profile_size for r, g in enumerate(top)) / (len(top) * profile_size) for lang, p in profiles.items()}
        best = max(alike, key=lambda x: (alike[x], [-ord(c) for c in x]))
        two = sorted(alike.values(), reverse=True)[:2]
        out.append((best, two[0] / max(sum(two), 1e-12)))
    return out
