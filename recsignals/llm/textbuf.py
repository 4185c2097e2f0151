"""Whole texts of Arrow batches as flat byte buffers, and vectorised hashing over them.

Tasks see a column of texts as one contiguous UTF-8 buffer plus row offsets, so
words, n-grams and byte windows are found with numpy instead of per-row Python.
Batches are grouped into blocks of bounded size; a text larger than a block forms
a block of its own and is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that a task works on at a time (single longer texts excepted).
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64): spreads every input bit over all output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=4)
def byte_codes(seed: int) -> np.ndarray:
    """A 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, extended on demand."""

    def __init__(self):
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = (1 << max((n - 2).bit_length(), 16)) + 1  # texts of a block, or a longer one
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                a = np.full(size, base & (2**64 - 1), dtype=U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class PrefixHash:
    """Hashes of arbitrary byte ranges of a buffer in constant time each."""

    def __init__(self, buf: np.ndarray, seed: int = 0):
        up, self._down = _powers.get(len(buf) + 1)
        self._sum = np.zeros(len(buf) + 1, U64)
        c = byte_codes(seed)[buf]
        c *= up[: len(buf)]
        np.cumsum(c, out=self._sum[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = self._sum[end] - self._sum[start]
        h *= self._down[start]
        return mix(h + (end - start).astype(U64))


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (bytes, row offsets); nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, raw, data = column.buffers()
    off = np.frombuffer(raw, np.int64 if large else np.int32, len(column) + 1, column.offset * (8 if large else 4)) if len(column) else np.zeros(1, np.int64)
    off = off.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8, int(off[-1] - off[0]), int(off[0])), off - off[0]


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` text bytes (or one row), as (rows, bytes, offsets)."""
    for batch in batches:
        buf, off = text_view(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at), buf[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to
    give_back()


def word_spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that stay inside a row: (start, end, first word of each row)."""
    w = is_word[buf]
    edge = np.empty(len(w) + 1, bool)
    if len(w) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cuts = off[(off > 0) & (off < len(w))]
    edge[0], edge[-1] = w[0], False
    np.greater(w[1:], w[:-1], out=edge[1:-1])
    edge[cuts] = w[cuts]
    start = np.flatnonzero(edge)
    edge[0], edge[-1] = False, w[-1]
    np.less(w[1:], w[:-1], out=edge[1:-1])
    edge[cuts] = w[cuts - 1]
    end = np.flatnonzero(edge)
    return start, end, np.searchsorted(start, off)


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[buf]


def word_table(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags: which bytes belong to words. Ranges are inclusive."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


def gram_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (length: words - n + 1)."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    h = word_hash[:m].copy()
    for j in range(1, n):
        h *= U64(_BASE)
        h += word_hash[j : m + j]
    return mix(h)


def segments(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges first[i] .. first[i] + length[i]."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    return shift + np.arange(total)
