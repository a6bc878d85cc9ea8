"""A filter of fixed size for 64-bit keys, sent to the tasks.

It has ``2 ** FILTER_BITS`` bits (32 MB), whatever the number of keys; a key's
top bits choose its bit.  It lets every key of its set pass, and some others,
which the step that uses it has to sort out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 28
U = np.uint64


def filter_bits(keys: DataFrame) -> np.ndarray:
    """The filter of the ``key`` column; at most ``2 ** 22`` words reach the driver."""
    at = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    words = keys.select(F.shiftright(at, 6).alias("w"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 as int))"
    ).alias("m")).groupBy("w").agg(F.expr("bit_or(m)").alias("m"))
    return gathered(words)


def words_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys the filter's words that are not empty: their places and bits."""
    at = keys >> U(64 - FILTER_BITS)
    w = at >> U(6)
    heads = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])[:len(w)])
    if not len(heads):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    m = np.bitwise_or.reduceat(U(1) << (at & U(63)), heads)
    return w[heads].astype(np.int64), m.view(np.int64)


def gathered(words: DataFrame) -> np.ndarray:
    """The filter of the words (long ``w``, ``m``) that tasks made."""
    got = words.toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    np.bitwise_or.at(bits, got["w"].to_numpy(), got["m"].to_numpy().view(np.uint64))
    return bits


def passes(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Indices of the keys that pass."""
    at = key >> U(64 - FILTER_BITS)
    return np.flatnonzero((bits[at >> U(6)] >> (at & U(63))) & U(1))
