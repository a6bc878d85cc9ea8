"""Hard negatives of anchors, found along lists that clusters of anchors share.

A row's score for an anchor is the integer inner product of ``floor(256 * x)``.
An anchor's positives are its first rows of the same label; for each positive the
first rows of other labels are wanted whose score lies within a share of the
positive's, not above it.

Both searches walk lists.  Anchors are assigned to the nearest of a few centroids.
For a cluster of anchors within the angle ``t`` of its centroid, a candidate of
norm ``n`` at the angle ``s`` from the centroid scores at most ``|anchor| * n *
cos(max(0, s - t))``.  The candidates are sorted by that bound once for the whole
cluster, and every member walks the list from its head until the next bound is
below the score that would still change its answer: then the rest is certified.

The rows are dealt into blocks of bounded size, anchors into groups; one task holds
one of each, with one list per cluster of the group.  A first pass over one row in
``HEAD`` of every block finds scores from which the walks of the other rows start
to be certified.  Centroids are fitted on ``FIT_ANCHORS`` anchors at most, chosen by
a hash; they decide how early walks end, never the result.

Defined results: rows with a null id, label or vector, or with a component that is
null or not finite, take no part; shorter vectors count as filled up with zeros;
rows repeated in full count as often as they occur, as anchors once; rows of the
anchor's own id are never its positives or negatives; equal scores go by id; a
positive of negative score has no negatives; an empty table gives no rows; extra
columns are ignored.  Norms must stay below ``2 ** 26``, so that scores are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.text import written_table
from rankfold.session import ship_package

# Fixed values of the query.
UNIT = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
SHARE = 80

# Production parameters.
MAX_CLUSTERS = 64
CLUSTER_ANCHORS = 16
FIT_ANCHORS = 4096
FIT_ROUNDS = 6
HEAD = 16
BLOCK_CELLS = 1 << 22
ANCHOR_CELLS = 1 << 22
STEP = 1024
SCORES_AT_ONCE = 1 << 22

# What rounding can add to an angle and a norm.
ANGLE_SLACK = 1e-7
NORM_SLACK = 1 + 1e-12

ROWS = "vec_id long, label long, v binary, norm double"
FOUND = "anchor_id long, anchor long, place int, id long, score long"
FOUND_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()),
                          ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


# ---------------------------------------------------------------- rows
def integer_rows(batch: pa.RecordBatch, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, row offsets, ``floor(unit * x)`` of all of them) of a batch
    whose last column is an array of doubles."""
    vectors = batch.column(batch.num_columns - 1)
    valid = np.ones(batch.num_rows, bool)
    for c in batch.columns:
        valid &= ~c.is_null().to_numpy(zero_copy_only=False)
    off = vectors.offsets.to_numpy()
    x = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    valid &= bad[off[1:]] == bad[off[:-1]]
    use = np.flatnonzero(valid)
    length = np.diff(off)
    inside = np.zeros(len(x) + 1, np.int64)
    np.add.at(inside, off[:-1][use], 1)
    np.add.at(inside, off[1:][use], -1)
    x = np.floor(unit * x[np.cumsum(inside[:-1]) > 0])
    return use, np.concatenate([[0], np.cumsum(length[use])]), x


def packed(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """Runs of 64-bit integers as a binary column."""
    raw = np.ascontiguousarray(values.astype("<i8"))
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [
        None, pa.py_buffer((off * 8).astype(np.int32)), pa.py_buffer(raw)])


def prepared(rows: DataFrame) -> DataFrame:
    """Written table of the rows that take part: label as used, integer vector, norm and
    a number that deals rows into blocks."""
    ship_package(rows.sparkSession)

    def integers(batches):
        for b in batches:
            use, off, x = integer_rows(b, UNIT)
            row = np.repeat(np.arange(len(use)), np.diff(off))
            norm = np.sqrt(np.bincount(row, x * x, len(use)))
            if len(norm) and norm.max() >= 1 << 26:
                raise ValueError("vectors are too long for exact scores")
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(use)), b.column(1).take(pa.array(use)),
                 packed(x, off), pa.array(norm)], names=["vec_id", "label", "v", "norm"])
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(
        F.col("label"))
    narrow = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias(
        "label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return written_table(narrow.mapInArrow(integers, ROWS).withColumn(
        "deal", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The packed vectors of a column as rows of doubles, filled up with zeros."""
    raw = column.to_pylist()
    out = np.zeros((len(raw), dim))
    if all(len(r) == 8 * dim for r in raw):
        return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), dim).astype(np.float64)
    for i, r in enumerate(raw):
        out[i, :len(r) // 8] = np.frombuffer(r, "<i8")
    return out


# ---------------------------------------------------------------- clusters
def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(n > 0, n, 1)


def fit_centroids(sample: np.ndarray, clusters: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centroids of the sample's directions by spherical k-means."""
    x = _unit(sample)
    c = x[:clusters].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        moved = (total * total).sum(1) > 0
        c[moved] = _unit(total[moved])
    return c


def _first(slot, score, ids, k: int) -> np.ndarray:
    """Indices of the ``k`` best of each slot, by score downwards, then id."""
    order = np.lexsort((ids, -score, slot))
    s = slot[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else s
    nth = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
    return order[nth < k]


class Wanted:
    """What the anchors of a group still look for: slots, each with a range of scores.

    Slot ``p * m + a`` is anchor ``a``'s place ``p``; ``low`` is a score below which an
    entry cannot change the slot's ``k`` best any more.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, same_label: bool, k: int):
        self.low, self.high, self.same, self.k = low, high, same_label, k
        self.slot = self.id = np.empty(0, np.int64)
        self.score = np.empty(0)

    def limit(self) -> np.ndarray:
        """Per anchor the lowest score that any of its slots still looks for."""
        return self.low.min(0)

    def add(self, a: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Enter the scores of anchors ``a`` (rows) for rows ``ids`` where ``fits``."""
        for p in range(len(self.low)):
            low, high = self.low[p, a][:, None], self.high[p, a][:, None]
            s = np.where(fits & (scores >= low) & (scores <= high), scores, -np.inf)
            if s.shape[1] > self.k:
                kth = np.partition(s, s.shape[1] - self.k, 1)[:, s.shape[1] - self.k, None]
                s[s < kth] = -np.inf
            r, c = np.nonzero(s > -np.inf)
            if not len(r):
                continue
            own = p * self.low.shape[1] + a[r]
            touched = np.isin(self.slot, own)
            slot = np.concatenate([self.slot[touched], own])
            score = np.concatenate([self.score[touched], s[r, c]])
            i = np.concatenate([self.id[touched], ids[c]])
            best = _first(slot, score, i, self.k)
            slot, score, i = slot[best], score[best], i[best]
            full, count = np.unique(slot, return_counts=True)
            ends = np.cumsum(count) - 1
            full, ends = full[count == self.k], ends[count == self.k]
            low = self.low.reshape(-1)
            low[full] = np.maximum(low[full], score[ends])
            self.slot = np.concatenate([self.slot[~touched], slot])
            self.score = np.concatenate([self.score[~touched], score])
            self.id = np.concatenate([self.id[~touched], i])


def walk(anchors: dict, rows: dict, centroids: np.ndarray, wanted: Wanted) -> int:
    """Walk every cluster's list of ``rows`` for its ``anchors``; both hold ``x``, ``norm``,
    ``id`` and ``label``.  Returns the number of scores computed."""
    u, x = _unit(anchors["x"]), _unit(rows["x"])
    near = u @ centroids.T
    own = np.argmax(near, 1)
    angle = np.arccos(np.clip(near[np.arange(len(own)), own], -1, 1))
    done = 0
    for c in np.unique(own).tolist():
        members = np.flatnonzero(own == c)
        gap = np.arccos(np.clip(x @ centroids[c], -1, 1)) - angle[members].max() - ANGLE_SLACK
        bound = rows["norm"] * np.cos(np.maximum(gap, 0)) * NORM_SLACK
        order = np.argsort(-bound, kind="stable")
        at = 0
        while at < len(order):
            reach = anchors["norm"][members] * bound[order[at]] * NORM_SLACK
            members = members[reach >= wanted.limit()[members]]
            if not len(members):
                break
            part = order[at:at + STEP]
            at += STEP
            step = max(1, SCORES_AT_ONCE // STEP)
            for i in range(0, len(members), step):
                a = members[i:i + step]
                s = anchors["x"][a] @ rows["x"][part].T
                alike = anchors["label"][a][:, None] == rows["label"][part][None, :]
                other = anchors["id"][a][:, None] != rows["id"][part][None, :]
                wanted.add(a, s, other & (alike if wanted.same else ~alike), rows["id"][part])
                done += s.size
    return done


# ---------------------------------------------------------------- search
def _search(anchors: DataFrame, rows: DataFrame, centroids, dim: int, blocks: int, groups: int,
            k: int) -> DataFrame:
    """The ``k`` best of every slot of the anchors, in every block of the rows.

    ``anchors`` has ``low`` (array, one per slot) and for negatives ``high``.
    """
    negatives = "high" in anchors.columns
    spots = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    left = anchors.select("*", F.pmod("anchor", F.lit(groups)).cast("int").alias("g"),
                          spots.alias("b"))
    right = rows.select(every.alias("g"), F.pmod(F.xxhash64("deal"), F.lit(blocks)).cast("int")
                        .alias("b"), "vec_id", "label", "v", "norm")

    def own(a: pa.Table, r: pa.Table) -> pa.Table:
        if not a.num_rows or not r.num_rows:
            return FOUND_SCHEMA.empty_table()

        def of(t):
            return {"x": matrix(t["v"], dim), "norm": t["norm"].to_numpy(),
                    "id": t["vec_id"].to_numpy(), "label": t["label"].to_numpy()}
        low = np.array(a["low"].to_pylist(), np.float64).T.copy()
        high = (np.array(a["high"].to_pylist(), np.float64).T.copy() if negatives
                else np.full(low.shape, np.inf))
        wanted = Wanted(low, high, not negatives, k)
        walk(of(a), of(r), centroids.value, wanted)
        place, spot = np.divmod(wanted.slot, a.num_rows)
        spot = pa.array(spot)
        return pa.Table.from_arrays(
            [a["vec_id"].take(spot), a["anchor"].take(spot), pa.array(place.astype(np.int32)),
             pa.array(wanted.id), pa.array(wanted.score.astype(np.int64))], schema=FOUND_SCHEMA)
    return left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(own, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of each slot over all blocks, with ``nth`` from 1."""
    w = Window.partitionBy("anchor_id", "anchor", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k)


def _both(anchors: DataFrame, rows: DataFrame, slots: int, k: int, search) -> DataFrame:
    """Search the head of the rows, then the others from the scores found there."""
    head = F.pmod(F.xxhash64(F.col("deal") + 1), F.lit(HEAD)) == 0
    first = written_table(_best(search(anchors, rows.filter(head)), k), "head")
    # a slot that is full in the head is done with what scores less
    reached = first.filter(F.col("nth") == k).groupBy("anchor_id", "anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("place", F.col("score").cast("double")))
                           ).alias("reached"))  # one entry per slot of an anchor
    start = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda p: F.greatest(
        F.get("low", p), F.coalesce(F.col("reached")[p], F.lit(float("-inf")))))
    raised = (anchors.join(reached.withColumnRenamed("anchor_id", "vec_id"),
                           ["vec_id", "anchor"], "left")
              .withColumn("low", start).drop("reached"))
    rest = search(written_table(raised, "raised"), rows.filter(~head))
    return written_table(_best(first.drop("nth").unionByName(rest), k), "best")


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """One row per anchor, positive and negative, ranked by score."""
    spark = rows.sparkSession
    table = prepared(rows)
    is_anchor = F.pmod("vec_id", F.lit(every)) == 0
    n, m, size = table.agg(F.count(F.lit(1)), F.sum(is_anchor.cast("long")),
                           F.max(F.length("v"))).first()
    dim, parallel = (size or 0) // 8, 2 * spark.sparkContext.defaultParallelism
    blocks = max(math.ceil(n * max(dim, 1) / BLOCK_CELLS), min(parallel, n // 512), 1)
    groups = max(math.ceil((m or 0) * max(dim, 1) / ANCHOR_CELLS), 1)
    key = F.xxhash64("vec_id", "label", "v")
    anchors = written_table(table.filter(is_anchor).select(
        "vec_id", key.alias("anchor"), "label", "v", "norm").dropDuplicates(["vec_id", "anchor"])
        .withColumn("low", F.array(F.lit(float("-inf")))), "anchors")
    # a sample of fixed size
    sample = anchors.orderBy(F.xxhash64("anchor")).limit(FIT_ANCHORS).select("v").toArrow()
    clusters = max(1, min(MAX_CLUSTERS, (m or 0) // CLUSTER_ANCHORS, sample.num_rows))
    centroids = spark.sparkContext.broadcast(
        fit_centroids(matrix(sample["v"], dim), clusters) if sample.num_rows
        else np.zeros((1, dim)))

    def search(a, r, k):
        return _search(a, r, centroids, dim, blocks, groups, k)
    near = _both(anchors, table, 1, positives, lambda a, r: search(a, r, positives))
    near = near.select("anchor_id", "anchor", F.col("nth").alias("place"),
                       F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # scores are whole numbers, so the lowest that is share % of a positive's is one too
    some = near.groupBy(F.col("anchor_id").alias("vec_id"), "anchor").agg(F.map_from_entries(
        F.collect_list(F.struct("place", "positive_score"))).alias("scores"))  # as many as places
    top = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda p: F.col("scores")[p])
    ranged = (anchors.drop("low").join(some, ["vec_id", "anchor"])
              .withColumn("top", top).drop("scores")
              .withColumn("high", F.transform("top", lambda s: F.when(
                  s >= 0, s.cast("double")).otherwise(F.lit(float("-inf")))))
              .withColumn("low", F.transform("top", lambda s: F.when(
                  s >= 0, F.ceil(s * share / F.lit(100.0)).cast("double")).otherwise(
                  F.lit(float("inf"))))).drop("top"))
    far = _both(written_table(ranged, "ranged"), table, positives, negatives,
                lambda a, r: search(a, r, negatives))
    return (far.withColumn("place", F.col("place") + 1)
            .join(near, ["anchor_id", "anchor", "place"])
            .select("anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
