"""Vectorised word handling inside Python tasks: Arrow strings to numpy.

Every helper works on one *block* of whole documents: the UTF-8 bytes of the
documents back to back, with their offsets. Nothing here is a path of its
own; the operators call it inside ``mapInArrow`` / grouped-map tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Blocks are cut at about this many bytes (a longer document is one block), so that arrays over them stay small.
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Odd multipliers of the rolling hashes (64-bit arithmetic wraps).
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD1342543DE82EF95)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand and kept per task."""

    def __init__(self, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.base, self.inverse, self.up, self.down = base, inverse, None, None

    @staticmethod
    def _series(b: np.uint64, n: int) -> np.ndarray:
        s = np.full(n, b, dtype=np.uint64)
        s[0] = 1
        return np.multiply.accumulate(s)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up is None or len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = self._series(self.base, size), self._series(self.inverse, size)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _prefix(values: np.ndarray, powers: _Powers) -> np.ndarray:
    up, _ = powers.get(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix hash of the bytes, for ``byte_range_hash``."""
    return _prefix(_BYTE_VALUE[data], _BYTE_POWERS)


def byte_range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end]; equal bytes give equal hashes anywhere."""
    _, down = _BYTE_POWERS.get(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


class Block:
    """Some whole documents: rows (positions in the source batch), bytes, offsets."""

    __slots__ = ("rows", "data", "offsets")

    def __init__(self, rows: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets


def _column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    return col


def _string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (relative to the bytes) of a string/binary array; null is empty."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(batch: pa.RecordBatch, name: str, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The text column cut into blocks of whole documents of about ``limit`` bytes."""
    data, offs = _string_buffers(_column(batch, name))
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield Block(np.arange(i, j), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        i = j


def values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A non-null integer column as numpy."""
    return _column(batch, name).to_numpy(zero_copy_only=False)


def word_bounds(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of the words ``[^\\x20\\x09-\\x0D]+`` and, for
    document k of the block, its first word index ``first[k]`` (n + 1 values)."""
    inside = ~_SPACE[block.data]
    before = np.zeros(len(inside) + 1, dtype=bool)
    before[1:] = inside
    before[block.offsets[:-1]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, dtype=bool)
    after[:-1] = inside
    after[block.offsets[1:]] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return _FOLD[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return byte_range_hash(byte_prefix(data), starts, ends)


def word_prefix(hashes: np.ndarray) -> np.ndarray:
    """Prefix hash of a sequence of word hashes, for ``window_hash``."""
    return _prefix(hashes, _WORD_POWERS)


def window_hash(prefix: np.ndarray, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """64-bit hash of words[start : start + length]."""
    _, down = _WORD_POWERS.get(len(prefix))
    return mix64((prefix[start + length] - prefix[start]) * down[start])


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, back to back."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
