"""Hashes of the words of many texts at once, on the Arrow buffers of a batch.

Used inside tasks.  A word's 64-bit hash is a polynomial over random byte
values, read off prefix sums, then mixed; equal words hash alike in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20231))
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
ODD = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def hand_back() -> None:
    """Return memory that is free in this process to the system, at the end of a task: a worker
    that is used again would hold what its largest task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def slices(column: pa.Array, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes.

    Yields (first row, row after the last, UTF-8 bytes, row offsets into them);
    null texts are empty.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, where, data = column.buffers()
    off = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte starts, byte ends, first word of each row and the total) of all words."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~_GAP[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word; with ``lower``, A-Z count as a-z."""
    table = _LOWER if lower else _BYTES
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _powers(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * ODD[63])
        i = j
    return out


def windows(h: np.ndarray, offsets, salt: int = 0) -> np.ndarray:
    """Hash of ``h[i + o] for o in offsets`` for each ``i`` that has them all."""
    n = len(h) - max(offsets)
    if n <= 0:
        return np.empty(0, np.uint64)
    s = np.full(n, int(ODD[62]) * (salt + 1) % (1 << 64), np.uint64)
    for k, o in enumerate(offsets):
        s += h[o:o + n] * ODD[k]
    return mix(s)
