"""Near-duplicate documents by min-max hashing.

A document's set holds its distinct runs of ``SHINGLE`` words (A-Z as a-z),
as 64-bit hashes.  Each of ``PERMUTATIONS`` hash permutations gives two
signature values, the least and the greatest hash of the set; each agrees
between two sets with a probability equal to their Jaccard similarity, so half
the permutations fill a signature.  ``ROWS`` values make a band key, minima and
maxima apart.  At the threshold, ``percent`` or ``PERCENT``, a pair shares none of
the bands with odds of ``(1 - 0.85 ** 4) ** 24``, about 2 in 10^8 (at 0.8, 3 in
10^6); further up with less.

Links are confirmed on full sets, and none of a bucket's links is skipped:

1. Equal sets are one class, represented by its smallest ``doc_id``.
2. Every representative is compared with the smallest one of each of its
   buckets, and the links found are joined into components.
3. Only buckets that still hold several components are looked at again.  Their
   members are cut into blocks of at most ``BLOCK``, and each block outside the
   component of the bucket's smallest member meets every block; all
   intersections of two blocks come from one matrix product, and a spanning
   forest of their links is returned.

So a large group of near copies costs one comparison for each member and band,
and pairs are never laid out as rows.

Defined results: a document of fewer than ``SHINGLE`` words is one shingle, all
its words; null and blank texts have an empty set and are linked with nothing;
rows without a ``doc_id`` are linked with nothing, have no component and are
kept; rows that repeat a ``doc_id`` are judged by their own texts, and rows
repeated in full are kept or dropped alike; an empty table gives no rows; extra
columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.bits import filter_bits, passes
from rankfold.llm.components import components
from rankfold.llm.text import discard, fresh, kept_table, release, written_table
from rankfold.session import ship_package

# Production parameters.
SHINGLE = 5
PERCENT = 85
PERMUTATIONS = 48
ROWS = 4
BLOCK = 256
AT_ONCE = 4096

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(411))
_A = (_RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), dtype=np.uint64) << U(1)) | U(1)
_B = _RNG.integers(0, 1 << 63, (PERMUTATIONS, 1), dtype=np.uint64)
SIGNATURES = "doc_id long, tie long, n_shingles long, set_a long, set_b long, keys array<long>"


def shingle_sets(column: pa.Array):
    """The sorted shingle hashes of each text, in order."""
    for _, _, data, off in hashing.slices(column):
        s, e, first = hashing.word_spans(data, off)
        h = hashing.word_hashes(data, s, e, lower=True)
        runs = hashing.windows(h, range(SHINGLE))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(runs[a:b - SHINGLE + 1])
            elif b > a:
                yield hashing.windows(h[a:b], range(b - a), salt=b - a)
            else:
                yield np.empty(0, U)


def signature(x: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of a set under every permutation."""
    low = np.full(PERMUTATIONS, ~U(0))
    high = np.zeros(PERMUTATIONS, U)
    for i in range(0, len(x), AT_ONCE):
        p = x[None, i:i + AT_ONCE] * _A + _B
        np.minimum(low, p.min(1), out=low)
        np.maximum(high, p.max(1), out=high)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key per band of ``ROWS`` values, different between bands."""
    v = sig.reshape(-1, ROWS)
    bands = np.arange(1, len(v) + 1, dtype=np.uint64) * hashing.ODD[60]
    return hashing.mix((v * hashing.ODD[None, :ROWS]).sum(1, dtype=np.uint64) + bands)


def signatures(docs: DataFrame) -> DataFrame:
    """Per document row: hash of the text, set size, 128-bit hash of the set, band keys."""
    ship_package(docs.sparkSession)

    def sign(batches):
        for b in batches:
            n, a, c, keys = [], [], [], []
            for x in shingle_sets(b.column(2)):
                n.append(len(x))
                a.append(int(hashing.mix(x).sum(dtype=np.uint64).view(np.int64)))
                c.append(int(hashing.mix(x * hashing.ODD[61] + hashing.ODD[59])
                             .sum(dtype=np.uint64).view(np.int64)))
                keys.append(band_keys(signature(x)).view(np.int64) if len(x) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(c, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "tie", "n_shingles", "set_a", "set_b", "keys"])
        hashing.hand_back()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("tie"), "text").mapInArrow(sign, SIGNATURES)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, set) of the documents in ``wanted`` (distinct ``doc_id``, ``set_a``,
    ``set_b``), one row each, as a written table.

    Texts stay where they were read: sets are made of those that a filter of the wanted
    ids lets pass, and only these are joined.
    """
    wanted = kept_table(wanted.select("doc_id", "set_a"))
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted.select(
        F.xxhash64("doc_id").alias("key"))))

    @F.pandas_udf("boolean")
    def may_be(key: pd.Series) -> pd.Series:
        out = np.zeros(len(key), bool)
        out[passes(bits.value, key.to_numpy().view(U))] = True
        return pd.Series(out)

    def load(batches):
        for b in batches:
            x = list(shingle_sets(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([int(hashing.mix(s).sum(dtype=np.uint64).view(np.int64))
                                        for s in x], pa.int64()),
                 pa.array([s.tobytes() for s in x], pa.binary())],
                names=["doc_id", "set_a", "set"])
        hashing.hand_back()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        may_be(F.xxhash64("doc_id")))
    sets = written_table(
        texts.mapInArrow(load, "doc_id long, set_a long, set binary")
        .join(wanted, ["doc_id", "set_a"], "left_semi")
        .dropDuplicates(["doc_id", "set_a"]).drop("set_a"), "sets")
    bits.destroy()
    discard(wanted)
    return sets


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity threshold."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(batches, percent: int):
    for b in batches:
        ok = [linked(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), percent)
              for x, y in zip(b.column(2), b.column(3))]
        yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    hashing.hand_back()


def forest(ids: list[int], sets: list[np.ndarray], left: int,
           percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join whatever the sets' links join: of the first ``left`` sets among
    themselves and with the rest (of all with each other if there is no rest)."""
    sizes = np.array([len(s) for s in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(where, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    shared = np.zeros((left, len(sets)), np.float32)
    use = often[where]
    cols, rows = column[where[use]], owner[use]
    order = np.argsort(cols, kind="stable")
    cols, rows = cols[order], rows[order]
    step = 1 << 13
    for c in range(0, int(often.sum()), step):
        i, j = np.searchsorted(cols, [c, c + step])
        m = np.zeros((len(sets), step), np.float32)
        m[rows[i:j], cols[i:j] - c] = 1
        shared += m[:left] @ m.T
    union = sizes[:left, None] + sizes[None, :] - shared
    root = list(range(len(sets)))

    def top(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v
    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(100 * shared >= percent * union))):
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def _blocks(batches, percent: int):
    """Rows (job, side, doc_id, set) sorted by job and side, to the links of each job."""
    def ended(ids, sets, left):
        links = forest(ids, sets, left, percent) if left and len(ids) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in links], pa.int64()),
             pa.array([y for _, y in links], pa.int64())], names=["a", "b"])
    job, ids, sets, left = None, [], [], 0
    for b in batches:
        for key, side, doc, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                     b.column(2).to_pylist(), b.column(3)):
            if key != job:
                if job is not None:
                    yield ended(ids, sets, left)
                job, ids, sets, left = key, [], [], 0
            ids.append(doc)
            sets.append(np.frombuffer(s.as_buffer(), U).copy())
            left += side == 0
    if job is not None:
        yield ended(ids, sets, left)
    ids, sets = [], []
    hashing.hand_back()


def _rest(spots: DataFrame, labels: DataFrame, docs: DataFrame, reps: DataFrame,
          percent: int) -> DataFrame:
    """Links within the buckets that still hold several components, as a written table."""
    named = spots.join(labels, F.col("doc_id") == F.col("node"), "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
    several = named.groupBy("key").agg(
        F.min(F.struct("doc_id", "comp"))["comp"].alias("main"), F.min("comp").alias("lo"),
        F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("who")).filter("lo <> hi")
    # buckets of the same members ask for the same work once
    once = several.groupBy("n", "who").agg(F.min(F.struct("key", "main")).alias("k")).select(
        "k.key", "k.main")
    # a document of several sets may be in a bucket with each of them
    members = named.join(once, "key").distinct().withColumn(
        "side", F.when(F.col("comp") == F.col("main"), 1).otherwise(0))
    counts = members.groupBy("key").agg(
        F.ceil(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)) / BLOCK).alias("n0"),
        F.ceil(F.sum("side") / BLOCK).alias("n1"))
    placed = kept_table(members.join(counts, "key").select(
        "key", "doc_id", "side", "n0", "n1",
        F.pmod(F.xxhash64("doc_id", F.lit(5)),
               F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))).alias("blk")))
    zero = F.lit(0).cast("long")
    others = F.sequence(zero, F.col("n0") - 1)
    me = F.col("blk")
    # jobs (i, j): block i outside the main component with block j, outside (i <= j) or, with
    # j counted from n0, inside it; a row says on which side of a job its document stands
    pair = (lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("at")))
    outside = F.concat(
        F.transform(F.filter(others, lambda j: j >= me), lambda j: pair(me, j, 0)),
        F.transform(F.filter(others, lambda i: i < me), lambda i: pair(i, me, 1)),
        F.when(F.col("n1") > 0, F.transform(
            F.sequence(zero, F.greatest(F.col("n1") - 1, zero)),
            lambda j: pair(me, F.col("n0") + j, 0)))
        .otherwise(F.array().cast("array<struct<i:bigint,j:bigint,at:int>>")))
    inside = F.transform(others, lambda i: pair(i, F.col("n0") + me, 1))
    rows = placed.withColumn("jobs", F.when(F.col("side") == 0, outside).otherwise(inside))
    rows = rows.select("key", "doc_id", F.inline("jobs")).select(
        F.concat_ws("/", "key", "i", "j").alias("job"), "at", "doc_id")
    want = placed.select("doc_id").distinct().join(reps, "doc_id")
    sets = _sets(docs, want)
    loaded = rows.join(sets, "doc_id")
    links = kept_table(loaded.repartition("job").sortWithinPartitions("job", "at", "doc_id")
            .select("job", "at", "doc_id", "set").mapInArrow(
                lambda batches: _blocks(batches, percent), "a long, b long"))
    discard(sets)
    discard(placed)
    release(docs.sparkSession)
    return links


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    return _judged(docs, percent).drop("tie")


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """``classes`` with ``tie``, the hash of the row's text."""
    signed = written_table(signatures(docs), "signatures")
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    # equal sets have equal keys
    first = kept_table(full.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys")))
    reps = first.drop("keys")
    spots = first.select("doc_id", F.explode(F.array_distinct("keys")).alias("key"))
    shared = spots.groupBy("key").agg(F.min("doc_id").alias("first"),
                                      F.max("doc_id").alias("last")).filter("first <> last")
    spots = kept_table(spots.join(shared.select("key", "first"), "key"))
    pairs = kept_table(spots.filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct())
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct().join(reps, "doc_id")
    sets = _sets(docs, ends)
    release(docs.sparkSession)
    links = kept_table(
        pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b")
        .join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a")
        .select("a", "b", "sa", "sb").mapInArrow(
            lambda batches: _confirm(batches, percent), "a long, b long"))
    discard(sets)
    discard(pairs)
    release(docs.sparkSession)
    labels = components(links)
    more = _rest(spots.select("key", "doc_id"), labels, docs, reps, percent)
    discard(spots)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = reps.join(labels, F.col("doc_id") == F.col("node"), "left").select(
        "set_a", "set_b", F.col("n_shingles").alias("_n"),
        F.coalesce("component", "doc_id").alias("_c"))
    own = (signed["n_shingles"] > 0) & signed["doc_id"].isNotNull()
    return (signed.join(named, own & (signed["set_a"] == named["set_a"])
                        & (signed["set_b"] == named["set_b"])
                        & (signed["n_shingles"] == named["_n"]), "left")
            .select("doc_id", "tie", "n_shingles",
                    F.coalesce("_c", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                           F.lit(True))))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with one of each component, the smallest ``doc_id``, kept.

    Whole rows are joined with the rows that go only where a filter of these rows' keys
    lets them pass; the others stay where they were read.
    """
    spark = docs.sparkSession
    name, tie = (fresh(docs, x) for x in ("_gone", "_tie"))
    gone = kept_table(_judged(docs, percent).filter("not kept").select(
        F.col("doc_id").alias(name), F.col("tie").alias(tie)).distinct())
    release(spark)
    bits = spark.sparkContext.broadcast(filter_bits(gone.select(
        F.xxhash64(name, tie).alias("key"))))

    @F.pandas_udf("boolean")
    def may_go(key: pd.Series) -> pd.Series:
        out = np.zeros(len(key), bool)
        out[passes(bits.value, key.to_numpy().view(U))] = True
        return pd.Series(out)
    own, text = docs["doc_id"].cast("long"), F.xxhash64(docs["text"])
    suspect = may_go(F.xxhash64(own, text))
    checked = docs.filter(suspect).join(
        gone, (own == F.col(name)) & (text == F.col(tie)), "left_anti")
    return docs.filter(~suspect).unionByName(checked)
