"""Arrow text columns as numpy arrays: bytes, words and hashed words of many texts at once.

``blocks`` cuts a column into runs of texts of a bounded number of bytes, so that the arrays
derived from them stay small; one text is never cut. Words are runs of bytes other than white
space (0x20, 0x09-0x0D), ASCII letters lower-cased. A word is known by a 64-bit hash.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES, KEPT_BYTES = 1 << 19, (1 << 21) + 1

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_LIBC = ctypes.CDLL(None)
#: Bytes of an array that is taken from the heap, and of free heap that is kept. With less, temporaries of a megabyte are handed back
#: to the system and asked for again at every step, which then clears their pages each time.
HEAP_ARRAY, HEAP_KEPT = 4 << 20, 32 << 20
if hasattr(_LIBC, "mallopt"):
    _LIBC.mallopt(-3, HEAP_ARRAY)  # M_MMAP_THRESHOLD
    _LIBC.mallopt(-1, HEAP_KEPT)  # M_TRIM_THRESHOLD
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, n + 1 at least; those of blocks up to ``KEPT_BYTES`` are kept."""
    size = next((k + 1 for k in (BLOCK_BYTES, KEPT_BYTES) if n <= k), n + 1)
    if size not in _POWERS:
        made = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _INVERSE))
        if size > KEPT_BYTES + 1:
            return made
        _POWERS[size] = made
    return _POWERS[size]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Sums s with s[j] - s[i] = codes[i:j] as a polynomial, times base**i."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes))[0][: len(codes)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the number of the first word of each text (and of the end)."""
        n = len(self.data)
        inside = ~_WHITE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return range_hash(prefix_hash(_CODES[self.data]), starts, ends)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on from task to task beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Texts]:
    """The column in runs of at most ``limit`` bytes (or one text); nulls are empty."""
    column = texts.cast(pa.large_binary()) if texts.type != pa.large_binary() else texts
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
    give_back()
