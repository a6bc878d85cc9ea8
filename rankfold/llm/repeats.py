"""Repeated windows of a fixed length, found through anchors.

A front end cuts each text into runs: consecutive windows that share one anchor,
where the anchor of a window depends on the window's content alone.  So equal
windows always have equal anchors, and a window whose anchor occurs once in the
corpus occurs once.  Three passes over the documents follow, each a map:

1. anchors are counted, and those that occur twice or more enter a filter of
   fixed size (see ``bits``), which also lets some others through; they travel
   sorted, as one value for each range of anchors and some ``HELD`` of them;
2. the runs of such anchors are grouped by (anchor, hash of all their windows):
   equal runs.  All but the first are repeats as a whole, so what many documents
   share is one row from here on;
3. where an anchor has several different runs, one of each comes with its content,
   and the operator resolves them window by window.

No step needs the runs of an anchor in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.bits import filter_bits, gathered, passes, words_of
from rankfold.llm.text import discard, release, written_table
from rankfold.session import ship_package

U = np.uint64
# Production parameter: anchors that a task of pass 1 holds before it hands them on.
HELD = 1 << 20


class Runs:
    """Runs of a slice of texts.

    ``key`` is each run's anchor hash.  For chosen runs, ``places`` gives row, first
    window (counted within the row) and number of windows, ``hashes`` a hash of all the
    windows, and ``content`` what tells the windows apart.
    """

    key: np.ndarray

    def places(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raise NotImplementedError

    def hashes(self, k: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def content(self, k: np.ndarray) -> list[bytes]:
        raise NotImplementedError


# a front end: (bytes, row offsets) -> Runs
Scan = Callable[[np.ndarray, np.ndarray], Runs]


def identified(docs: DataFrame) -> DataFrame:
    """(doc, tie, text): documents with no id come last; rows that share an id are told
    apart by a hash of their text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2 ** 63 - 1)).alias("doc"),
        F.xxhash64("text").alias("tie"), "text", F.col("doc_id").cast("long").alias("doc_id"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def often(docs: DataFrame, scan: Scan) -> DataFrame:
    """Pass 1: the filter's words (``w``, ``m``) of the anchors of two or more runs."""
    # some ranges for each partition, so that these come out alike
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift = U(64 - min(max((4 * parts - 1).bit_length(), 1), 16))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        key = np.sort(np.concatenate(held))
        twice = np.ones(len(key), bool)  # two of a kind tell as much as more
        twice[2:] = key[2:] != key[:-2]
        key = key[twice]
        at = key >> shift
        cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(at[cuts].astype(np.int32)),
             pa.array([x.tobytes() for x in np.split(key, cuts[1:])], pa.binary())],
            names=["part", "keys"])

    def keys(batches):
        held, n = [], 0
        for b in batches:
            for _, _, data, off in hashing.slices(b.column(0)):
                key = scan(data, off).key
                if len(key):
                    held.append(key)
                    n += len(key)
                if n >= HELD:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)
        held = []
        hashing.hand_back()

    def words(batches):
        held = [np.frombuffer(k.as_buffer(), U) for b in batches for k in b.column(1)]
        key = np.sort(np.concatenate([np.empty(0, U), *held]))
        w, m = words_of(key[1:][key[1:] == key[:-1]])
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(m)], names=["w", "m"])
        del held, key
        hashing.hand_back()
    return (docs.select("text").mapInArrow(keys, "part int, keys binary")
            .repartition("part").mapInArrow(words, "w long, m long"))


def runs(docs: DataFrame, scan: Scan, bits, content: bool = False) -> DataFrame:
    """Passes 2 and 3: the runs whose anchors pass the filter, in pass 3 with content.

    From here on 32 bits of the anchor do, next to the 64 of a run or window.
    """
    def chosen(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, data, off in hashing.slices(b.column(2)):
                r = scan(data, off)
                k = passes(bits.value, r.key << U(32) if content else r.key)
                cols = {"key": pa.array(r.key[k].astype(np.uint32).view(np.int32)),
                        "run": _signed(r.hashes(k))}
                if content:
                    cols["content"] = pa.array(r.content(k), pa.binary())
                else:
                    row, first, n = r.places(k)
                    row = pa.array(lo + row)
                    cols |= {"doc": b.column(0).take(row), "tie": b.column(1).take(row),
                             "first": pa.array(first.astype(np.int32)),
                             "n": pa.array(n.astype(np.int32))}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
                del r, k, cols  # before the next slice's
        hashing.hand_back()
    return docs.select("doc", "tie", "text").mapInArrow(
        chosen, "key int, run long, content binary" if content
        else "key int, run long, doc long, tie long, first int, n int")


def place(order: list[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def repeated(docs: DataFrame, scan: Scan, width: int, order: list[str],
             resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(doc, tie, cuts): per document row the spans ``[from, to)`` covered by windows of
    ``width`` that also occur earlier, where ``order`` says what earlier means.

    ``docs`` comes from ``identified``.  ``resolve`` gets the different runs of anchors
    that have several (key, run, m, of_key, content), ``m`` being the first place of each by
    ``order`` and ``of_key`` the number of runs of its anchor, and returns (key, run,
    part): the ranges of windows, counted from the run's first, that also occur before ``m``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bits = spark.sparkContext.broadcast(gathered(often(docs, scan)))
    release(spark)
    found = written_table(runs(docs, scan, bits), "runs")
    bits.destroy()
    kinds = written_table(found.groupBy("key", "run").agg(
        F.min(place(order)).alias("m"), F.count(F.lit(1)).alias("c")), "kinds")
    release(spark)
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("of_key")).filter("of_key > 1")
    # written, so that neither the filter nor what ``resolve`` does with them counts again
    several = written_table(kinds.drop("c").join(several, "key"), "several")
    bits = spark.sparkContext.broadcast(filter_bits(several.select(
        F.shiftleft(F.col("key").cast("long"), 32).alias("key"))))
    content = runs(docs, scan, bits, content=True).groupBy("key", "run").agg(
        F.first("content").alias("content"))
    part = written_table(resolve(content.join(several, ["key", "run"])), "parts")
    bits.destroy()
    discard(several)
    release(spark)
    # a run that occurs once, with no window found earlier, is of no further use; written, so
    # that the next join shuffles both sides and a frequent run's partition can be split
    state = written_table(kinds.join(part, ["key", "run"], "left").filter(
        "c > 1 or part is not null").drop("c"), "state")
    discard(kinds)
    discard(part)
    whole = F.array(F.struct(F.col("first").alias("a"),
                             (F.col("first") + F.col("n") + (width - 1)).alias("b")))
    some = F.transform("part", lambda p: F.struct(
        (F.col("first") + p["a"]).alias("a"), (F.col("first") + p["b"] + (width - 1)).alias("b")))
    spans = found.join(state, ["key", "run"]).select(
        "doc", "tie", F.when(place(order) > F.col("m"), whole).otherwise(some).alias("c"))
    cuts = written_table(spans.filter("c is not null").select("doc", "tie", F.inline("c"))
                         # a row's spans are bounded by its own length
                         .groupBy("doc", "tie")
                         .agg(F.collect_set(F.struct("a", "b")).alias("cuts")), "cuts")
    discard(found)
    discard(state)
    release(spark)
    return cuts


def disjoint(row: np.ndarray, a: np.ndarray, b: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint spans (row, start, end), sorted, that cover the same places of each row."""
    order = np.lexsort((a, row))
    row, a, b = row[order], a[order].astype(np.int64), b[order].astype(np.int64)
    if not len(row):
        return row, a, b
    # rows one after the other, with a place between them
    width = int(b.max()) + 1
    reach = np.maximum.accumulate(row * width + b)
    new = np.flatnonzero(np.concatenate([[True], (row * width + a)[1:] > reach[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(a) - 1]])
    return row[new], a[new], reach[last] - row[new] * width


def merged(cuts) -> tuple[np.ndarray, np.ndarray]:
    """``disjoint`` of one row's spans: their starts and ends."""
    return disjoint(np.zeros(len(cuts), np.int64), np.array([c["a"] for c in cuts], np.int64),
                    np.array([c["b"] for c in cuts], np.int64))[1:]
