"""Vectorised helpers on the bytes of a batch of texts, for use inside Spark tasks.

A batch of texts is one ``uint8`` buffer plus ``int64`` offsets, as Arrow stores it.
Every function is linear in the buffer and keeps no state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary()).fill_null(b"") if binary else column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_ranges(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one text that is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1, i + 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = (n | 0x3FFFF) + 1
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


def forget_powers() -> None:
    """Lets the powers that one long text needed go again."""
    if len(_powers.up) > 1 << 21:
        _powers.__init__()


def prefix_hash(buffer: np.ndarray) -> np.ndarray:
    """Prefix sums for ``span_hash``; one longer than the buffer."""
    out = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * _powers.to(len(buffer) + 1)[0][: len(buffer)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``buffer[start:end]``: equal bytes give equal hashes wherever they stand."""
    down = _powers.to(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
PUNCT = np.zeros(256, bool)
PUNCT[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(buffer: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of other bytes than ``separator``, and word offsets per text."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = ~separator[buffer]
    step = np.diff(inside)
    cuts = np.unique(offsets[1:-1]) if len(offsets) > 2 else np.zeros(0, np.int64)
    cuts = cuts[(cuts > 0) & (cuts < len(buffer))]
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # a word may not run over the end of its text
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if len(cuts):
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    return start, end, np.searchsorted(start, offsets)
