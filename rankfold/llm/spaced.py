"""Benchmark decontamination by spaced-seed hashing.

Words are compared with A-Z as a-z.  A document overlaps a benchmark item if
some ``WINDOW`` consecutive words of each, aligned one to one, differ in at
most ``SUBSTITUTIONS`` places.  A shorter item must lie in the document as a whole:
of ``TOLERANT`` words or more with at most one word changed, of fewer unchanged; an
item of one or two words must be all there is in the document.  Candidates come
from spaced seeds: each mask hashes the words at its 1 positions and ignores those
at its 0 positions, and the masks are chosen such that every window with two
substitutions still has a hit of one of them.  Shorter items have a mask of four
words, which one changed word leaves a hit of, or of as many as they have.  Each
hit gives an alignment of document and item, and alignments are verified on
the words of the whole item, not only near the hit.

The benchmark goes to the tasks in parts of at most ``PART_WORDS`` words, and
the documents are passed once per part, in a map without a shuffle; so what a
task holds is bounded however large the benchmark is, and no hot hash or item
can gather rows in one task.

Defined results: null and blank texts and items overlap nothing; equal items of
different ids are all reported, items that share an id with different texts one by
one, and null ids stay null; rows that share a ``doc_id`` with different texts are
judged one by one; rows of documents or items that are repeated in full are reported
once by ``contaminated``, and ``keep_clean`` judges each row; extra columns are
kept by ``keep_clean`` and ignored by ``overlaps``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.text import words
from rankfold.session import ship_package

# Production parameters.
WINDOW = 13
SUBSTITUTIONS = 2
TOLERANT = 8
MASKS = ("111111", "1111011", "1110111", "1101111", "11110101")
# (mask, fewest and most words of the items it is for) of items shorter than a window
SHORT_MASKS = (("1111", 4, WINDOW - 1), ("111", 3, 3), ("1", 1, 2))
WHOLE = 2  # an item of up to so many words must be the whole document
PART_WORDS = 2_000_000
FILTER_BITS = 24
PAIRS_AT_ONCE = 1 << 20

SPANS = ("doc_id long, tie long, item_id long, item_tie long, first_word long, n_words long, "
         "n_equal long")
EVERY_MASK = tuple((m, WINDOW, 1 << 62) for m in MASKS) + SHORT_MASKS


class Seeds:
    """The seeds of one part of the benchmark, sorted, with a bitmap (2 MB) before them."""

    def __init__(self, ids: pa.Array, ties: pa.Array, texts: pa.Array):
        self.ids, self.ties = ids, ties
        self.h, self.first = np.empty(0, np.uint64), np.zeros(1, np.int64)
        if len(texts):
            _, _, data, off = next(hashing.slices(texts, 1 << 62))
            s, e, self.first = hashing.word_spans(data, off)
            self.h = hashing.word_hashes(data, s, e, lower=True)
        size = np.diff(self.first)
        self.item = np.repeat(np.arange(len(size)), size)
        self.masks = []
        for k, (m, least, most) in enumerate(EVERY_MASK):
            seed = hashing.windows(self.h, care(m), k)
            own = self.item[:len(seed)]
            at = np.flatnonzero((np.arange(len(seed)) + len(m) <= self.first[1:][own])
                                & (size[own] >= least) & (size[own] <= most))
            order = at[np.argsort(seed[at], kind="stable")]
            seen = np.zeros(1 << (FILTER_BITS - 6) if len(order) else 1, np.uint64)
            place = seed[order] >> np.uint64(64 - FILTER_BITS)
            np.bitwise_or.at(seen, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
            self.masks.append((seed[order], order, seen))


def tolerance(n: int) -> int:
    """Substitutions allowed in an item of ``n`` words that is shorter than a window."""
    return 1 if n >= TOLERANT else 0


def care(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _alignments(h: np.ndarray, row: np.ndarray, last: np.ndarray, b: Seeds
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item index, document word aligned with the item's first word), each once,
    with the document's row in the order of words."""
    size = np.diff(np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])))
    size = np.repeat(size, size)  # of the document that a word is in
    for k, (m, least, most) in enumerate(EVERY_MASK):
        seeds, where, seen = b.masks[k]
        if not len(seeds):
            continue
        s = hashing.windows(h, care(m), k)
        place = s >> np.uint64(64 - FILTER_BITS)
        at = np.flatnonzero((seen[place >> np.uint64(6)] >> (place & np.uint64(63)))
                            & np.uint64(1))
        at = at[at + len(m) <= last[at]]
        if most <= WHOLE:
            at = at[size[at] <= most]
        lo, hi = np.searchsorted(seeds, s[at], "left"), np.searchsorted(seeds, s[at], "right")
        hit = hi > lo
        at, lo, n = at[hit], lo[hit], (hi - lo)[hit]
        i = 0
        ends = np.cumsum(n)
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS_AT_ONCE)))
            c = n[i:j]
            spot = where[np.repeat(lo[i:j] - np.cumsum(c) + c, c) + np.arange(c.sum())]
            item = b.item[spot]
            yield item, np.repeat(at[i:j], c) - (spot - b.first[item])
            i = j


def _find(data, off, b: Seeds) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first word, words, equal words) of each overlap of a slice."""
    s, e, first = hashing.word_spans(data, off)
    if not len(s):
        return []
    h = hashing.word_hashes(data, s, e, lower=True)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    last = first[1:][row]
    out = []
    pairs = []
    for item, start in _alignments(h, row, last, b):
        # the document word under the item's first word may lie before the document, so the
        # row comes from a word that both have: the hit itself is in range
        pairs.append(np.unique(np.stack([item, start]), axis=1))
    if not pairs:
        return out
    for item, start in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
        a, z = int(b.first[item]), int(b.first[item + 1])
        lo, hi = max(start, 0), min(start + z - a, len(h))
        equal = h[lo:hi] == b.h[a + lo - start:a + hi - start]
        rows = row[lo:hi]
        for r in np.unique(rows):
            part = np.flatnonzero(rows == r)
            eq = equal[part[0]:part[-1] + 1]
            if z - a < WINDOW:
                if (len(eq) == z - a and z - a - eq.sum() <= tolerance(z - a)
                        and (z - a > WHOLE or first[r + 1] - first[r] == z - a)):
                    out.append((int(r), item, lo + int(part[0]) - int(first[r]), z - a,
                                int(eq.sum())))
                continue
            if len(eq) < WINDOW:
                continue
            sums = np.concatenate([[0], np.cumsum(eq)])
            good = np.flatnonzero(sums[WINDOW:] - sums[:-WINDOW] >= WINDOW - SUBSTITUTIONS)
            if not len(good):
                continue
            cuts = np.flatnonzero(np.diff(good) > WINDOW) + 1
            for g in np.split(good, cuts):
                x, y = int(g[0]), int(g[-1]) + WINDOW
                out.append((int(r), item, lo + int(part[0]) + x - int(first[r]),
                            y - x, int(sums[y] - sums[x])))
    return out


def _parts(benchmark: DataFrame, part_words: int) -> Iterator[Seeds]:
    """The benchmark in parts of about ``part_words`` words; one part is on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "n", F.size(words(F.col("text")))).filter("n > 0")
    total = items.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // part_words)
    for k in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        t = own.select("item_id", F.xxhash64("text").alias("tie"), "text").orderBy(
            "item_id", "text").toArrow().combine_chunks()
        yield Seeds(t["item_id"].combine_chunks(), t["tie"].combine_chunks(),
                    t["text"].combine_chunks())


def overlaps(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """One row per overlapping span of a document and a benchmark item."""
    ship_package(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.xxhash64("text").alias("tie"), "text")
    out = docs.sparkSession.createDataFrame([], SPANS)
    for part in _parts(benchmark, part_words):
        seeds = sc.broadcast(part)

        def find(batches, seeds=seeds):
            for batch in batches:
                for lo, _, data, off in hashing.slices(batch.column(2)):
                    found = _find(data, off, seeds.value)
                    if found:
                        r, item, first, n, eq = (pa.array(x, pa.int64()) for x in zip(*found))
                        r = pa.array(r.to_numpy() + lo)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(r), batch.column(1).take(r),
                             seeds.value.ids.take(item), seeds.value.ties.take(item),
                             first, n, eq],
                            names=["doc_id", "tie", "item_id", "item_tie", "first_word",
                                   "n_words", "n_equal"])
            hashing.hand_back()
        out = out.unionByName(narrow.mapInArrow(find, SPANS))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS
                 ) -> DataFrame:
    """One row per document and item that overlap: spans, words and equal words."""
    return (overlaps(docs, benchmark, part_words).distinct()
            .groupBy("doc_id", "tie", "item_id", "item_tie")
            .agg(F.count(F.lit(1)).alias("n_spans"), F.sum("n_words").alias("n_words"),
                 F.sum("n_equal").alias("n_equal")).drop("tie", "item_tie"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS
               ) -> DataFrame:
    """The documents that overlap no item, with their columns."""
    ship_package(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index("text")
    for part in _parts(benchmark, part_words):
        seeds = sc.broadcast(part)

        def clean(batches, seeds=seeds):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, data, off in hashing.slices(batch.column(at)):
                    keep[[lo + x[0] for x in _find(data, off, seeds.value)]] = False
                yield batch.filter(pa.array(keep))
            hashing.hand_back()
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
