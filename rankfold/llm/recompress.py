"""Repeated word windows by recompression.

Words are symbols, named by 64-bit hashes.  Each of ``ROUNDS`` rounds first
replaces maximal runs of one symbol by a symbol named after symbol and length,
then splits all symbols in two classes by a hash bit and replaces each pair of a
first-class and a second-class neighbour by a symbol named after both.  Names
depend on what they stand for alone, so they are the same in all documents, and
so is the parse of equal substrings but for their ends.

Every symbol carries the words its parse depends on.  A symbol is interior to a
window if all of these lie in it; then it appears in every copy of the window.
Each window takes its interior symbol of the highest round, of several the one
with the least hash, of equal ones the first; its anchor is that symbol with the
words around it that all windows hold in whose first half it begins, or in whose
second half.  A window without interior symbols (long runs of one word) is its
own anchor.  Documents that share an anchor are verified: their windows are
compared by a 64-bit hash of their words within an anchor.

Defined results: null and blank texts have no words; documents without an id
come after all others; rows that share an id are ordered by a hash of their
text, and rows repeated in full are not repeats of each other; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.repeats import Runs, identified, merged, repeated

# Fixed value: words in a window.
WINDOW = 20
# Production parameters.
ROUNDS = 2
HALF = 10
PLACE_BITS = 28

U = np.uint64
ORDER = ["doc", "tie", "first"]
RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
          "spans array<struct<a:long,b:long>>")


def parse(h: np.ndarray, row: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Per round: (symbols, their first words, first and last + 1 of the words each
    depends on).

    What depends on the end of a text depends on a place beyond it, so it is in no window.
    """
    begin = (first[:-1] - 1).astype(np.int32)
    end = (first[1:] + 1).astype(np.int32)
    sym, at = h, row.astype(np.int32)
    word = np.arange(len(h), dtype=np.int32)
    lo, hi = word, word + np.int32(1)
    out = []
    for k in range(rounds):
        # maximal runs; that a run ends shows in the neighbours on both sides
        same_row = at[1:] == at[:-1]
        new = np.ones(len(sym), bool)
        new[1:] = (sym[1:] != sym[:-1]) | ~same_row
        s = np.flatnonzero(new)
        e = np.append(s[1:], len(sym))
        n = e - s
        if len(s) < len(sym):
            long = np.flatnonzero(n > 1)
            name = sym[s]
            name[long] = hashing.mix(name[long] + n[long].astype(np.uint64) * hashing.ODD[50 + k])
            sym, word, left, right, at = name, word[s], lo[s], hi[e - 1], at[s]
            same_row = at[1:] == at[:-1]
        else:
            left, right = lo, hi
        lo, hi = begin[at], end[at]
        lo[1:] = np.where(same_row, left[:-1], lo[1:])
        hi[:-1] = np.where(same_row, right[1:], hi[:-1])
        # pairs; a symbol stays single because of the neighbour it does not pair with
        second = (sym * hashing.ODD[40 + k] >> U(63)).astype(bool)
        joins = np.zeros(len(sym), bool)
        joins[:-1] = ~second[:-1] & second[1:] & same_row
        wide_lo, wide_hi = begin[at], end[at]
        wide_lo[1:] = np.where(same_row, lo[:-1], wide_lo[1:])
        wide_hi[:-1] = np.where(same_row, hi[1:], wide_hi[:-1])
        p = np.flatnonzero(joins)
        name = sym.copy()
        name[p] = hashing.mix(sym[p] * hashing.ODD[30] + sym[p + 1] * hashing.ODD[31])
        head = np.ones(len(sym), bool)
        head[p + 1] = False
        # a pair reaches to the end of its second symbol, as a single first-class one does
        lo = np.where(second, wide_lo, lo)[head]
        hi = np.where(second, hi, wide_hi)[head]
        sym, word, at = name[head], word[head], at[head]
        out.append((sym, word, lo, hi))
    return out


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of ``values[a:b]`` for each pair, all of them non-empty."""
    out = np.empty(len(a), values.dtype)
    size, table, n = 1, values, b - a
    while True:
        own = np.flatnonzero((n >= size) & (n < 2 * size))
        out[own] = np.minimum(table[a[own]], table[b[own] - size])
        if not (n >= 2 * size).any():
            return out
        table = np.minimum(table[:-size], table[size:])
        size *= 2


def _joined(x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """Names of two neighbouring strings of words, ``y``'s beginning ``step`` words on."""
    n = max(len(y) - step, 0)
    z = x[:n] * hashing.ODD[35] + y[step:step + n] * hashing.ODD[36]
    return (z ^ (z >> U(29))) * hashing.ODD[37]


class _Runs(Runs):
    """Runs of word windows; see ``repeats``."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        s, e, first = hashing.word_spans(data, off)
        h = hashing.word_hashes(data, s, e)
        self.row = row = np.repeat(np.arange(len(off) - 1), np.diff(first))
        self.first = first
        two = _joined(h, h, 1)
        eight = _joined(four := _joined(two, two, 2), four, 4)
        prints = _joined(_joined(eight, eight, 8), four, 16)
        around = _joined(_joined(eight, two, 8), h, 10)
        starts = np.flatnonzero(np.arange(len(prints)) + WINDOW <= first[1:][row[:len(prints)]])
        self.prints = prints[starts]
        key = hashing.mix(self.prints ^ hashing.ODD[20])
        place = np.full(len(starts), -1, np.int64)
        open_ = np.arange(len(starts))
        mask = U((1 << PLACE_BITS) - 1)
        for k, (sym, word, lo, hi) in reversed(list(enumerate(
                parse(h, row, first) if len(starts) else []))):
            w = starts[open_].astype(np.int32)
            a = np.searchsorted(lo, w, "left")
            b = np.searchsorted(hi, w + np.int32(WINDOW), "right")
            found = a < b
            inside = np.flatnonzero(found)
            rank = ((sym * hashing.ODD[21]) & ~mask) | np.arange(len(sym), dtype=np.uint64)
            best = (_least(rank, a[inside], b[inside]) & mask).astype(np.int64)
            at = open_[inside]
            # the words around that every window of its half holds
            begins = word[best].astype(np.int64)
            late = begins - starts[at] >= HALF
            key[at] = hashing.mix(around[begins - np.where(late, HALF, 0)]
                                  + sym[best] * hashing.ODD[22] + late.astype(np.uint64))
            place[at] = (best * ROUNDS + k) * 2 + late
            open_ = open_[~found]
        new = np.ones(len(starts), bool)
        new[1:] = ((place[1:] != place[:-1]) | (place[1:] < 0)
                   | (row[starts[1:]] != row[starts[:-1]]))
        self.begin = np.flatnonzero(new)
        self.n = np.diff(np.append(self.begin, len(starts)))
        self.start = starts[self.begin]
        self.key = key[self.begin]

    def places(self, k):
        row = self.row[self.start[k]]
        return row, self.start[k] - self.first[row], self.n[k]

    def hashes(self, k):
        if not len(k):
            return np.empty(0, np.uint64)
        nth = np.arange(len(self.prints)) - np.repeat(self.begin, self.n)
        each = hashing.mix(self.prints + nth.astype(np.uint64) * hashing.ODD[23])
        return hashing.mix(np.add.reduceat(each, self.begin)[k])

    def content(self, k):
        return [self.prints[a:a + c].tobytes()
                for a, c in zip(self.begin[k].tolist(), self.n[k].tolist())]


def _resolve(kinds: DataFrame) -> DataFrame:
    """Windows of different runs of one anchor, compared by their hashes."""
    def spread(batches):
        for b in batches:
            n = [len(c.as_buffer()) // 8 for c in b.column(3)]
            rows = pa.array(np.repeat(np.arange(b.num_rows), n))
            prints = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int64)
            nth = [i for k in n for i in range(k)]
            m = b.column(2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), b.column(1).take(rows), pa.array(prints),
                 *[m.field(f).take(rows) for f in ORDER[:2]],
                 pa.array(np.repeat(m.field("first").to_numpy(), n) + nth, pa.int64()),
                 pa.array(nth, pa.int32())],
                names=["key", "run", "print", "doc", "tie", "first", "nth"])
    each = kinds.select("key", "run", "m", "content").mapInArrow(
        spread, "key int, run long, print long, doc long, tie long, first long, nth int")
    each = each.withColumn("own", F.struct(*ORDER))
    # the anchor and the print together name a window
    least = each.groupBy("key", "print").agg(F.min("own").alias("least"),
                                             F.count(F.lit(1)).alias("c")).filter("c > 1")
    late = each.join(least, ["key", "print"]).filter(F.col("own") > F.col("least"))
    return late.groupBy("key", "run").agg(F.collect_list(F.struct(
        F.col("nth").alias("a"), (F.col("nth") + 1).alias("b"))).alias("part"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document row: word counts, hash and text of the kept words, and the
    removed spans of words."""
    own = identified(docs)
    cuts = repeated(own, _Runs, WINDOW, ORDER, _resolve).select(
        F.col("doc").alias("_d"), F.col("tie").alias("_t"), "cuts")

    def apply(batches):
        for b in batches:
            out = []
            for doc_id, text, spans in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = (text or "").encode().split()
                n, gone, ranges = len(w), 0, []
                if spans:
                    a, z = merged(spans)
                    ranges = [{"a": int(x), "b": int(y)} for x, y in zip(a, z)]
                    for x, y in zip(a[::-1].tolist(), z[::-1].tolist()):
                        del w[x:y]
                        gone += y - x
                kept = b" ".join(w)
                out.append({"doc_id": doc_id, "n_words": n, "n_removed": gone,
                            "kept_sha256": hashlib.sha256(kept).hexdigest(),
                            "kept": kept.decode(), "spans": ranges})
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
    return (own.join(cuts, (F.col("doc") == F.col("_d")) & (F.col("tie") == F.col("_t")), "left")
            .select("doc_id", "text", "cuts").mapInArrow(apply, RESULT))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.string()),
                     ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
