"""Whitening of vectors by principal components, found by spectrum slicing.

Every component c of a vector becomes the integer ``x = floor(64 * c) + 1000000``.
The fit list holds each distinct integer vector once.  Its sums are taken first,
then products of vectors centred at the sums' rounded mean; all of that is whole
numbers, summed by Spark, so the covariance is exact but for its last rounding and
does not depend on how the rows are spread.

The covariance has the size of the vectors, however many there are; its leading
eigenvalues are found from it alone.  ``L D L'`` of the matrix less a shift has as
many positive pivots as there are eigenvalues above the shift (Sylvester), so
halving an interval by such counts isolates each of the leading eigenvalues.
Rayleigh quotient iteration, which converges cubically, takes over in the interval
and starts again from a narrower one should it leave.  Counts on both sides of each
value found certify its number.  Eigenvalues that no shift tells apart share one
interval; there the same iteration runs on a block of vectors.

Defined results: rows whose vector is null, of another length than the longest, or
with components that are null or not finite are dropped; rows repeated in full are
whitened each and fitted once; components without variance are left out (with a
single distinct vector, all of them); an empty table gives no rows; extra columns are
ignored.  Integers must stay below ``2 ** 40`` in size; a deviation beyond 64 bits
is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.negatives import integer_rows, packed
from rankfold.llm.text import written_table
from rankfold.session import ship_package

# Fixed values of the query.
UNIT = 64
SHIFT = 1_000_000
COMPONENTS = 16

# Production parameters.
SLICE_ROWS = 4096
TOGETHER = 1e-9      # eigenvalues nearer than this share of the largest share an interval
NO_VARIANCE = 1e-13  # eigenvalues below this share of the largest count as zero
MAX_ROUNDS = 60

OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


# ---------------------------------------------------------------- L D L'
def positive_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, from the pivots of its
    ``L D L'`` with pivots of one or two rows (Bunch and Kaufman)."""
    a = a.copy()
    n, k, positive = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while k < n:
        col = np.abs(a[k + 1:, k])
        most = col.max() if len(col) else 0.0
        size, at = 1, k
        if abs(a[k, k]) < alpha * most:
            r = k + 1 + int(col.argmax())
            other = np.abs(a[k:, r])
            other[r - k] = 0.0
            widest = other.max()
            if abs(a[k, k]) * widest < alpha * most * most:
                size, at = (1, r) if abs(a[r, r]) >= alpha * widest else (2, r)
        swap = k + size - 1
        if at != swap:
            a[[swap, at]] = a[[at, swap]]
            a[:, [swap, at]] = a[:, [at, swap]]
        if size == 1:
            d = a[k, k]
            if d != 0:
                positive += d > 0
                v = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(v, v / d)
        else:
            # a block of two is chosen only where its pivots have opposite signs
            d = a[k:k + 2, k:k + 2]
            positive += 1
            v = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= v @ np.linalg.solve(d, v.T)
        k += size
    return int(positive)


class Slices:
    """Counts of eigenvalues above a shift, each shift factorised once."""

    def __init__(self, v: np.ndarray):
        self.v, self.known = v, {}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = positive_pivots(self.v - shift * np.eye(len(self.v)))
        return self.known[shift]

    def isolate(self, number: int, low: float, high: float, width: float
                ) -> tuple[float, float]:
        """An interval that holds eigenvalue ``number`` (from 1, falling) and no other, or is
        as narrow as ``width``."""
        for shift in self.known:  # counts that are there already
            if low < shift < high:
                low, high = (shift, high) if self.above(shift) >= number else (low, shift)
        while high - low > width and (self.above(low) != number
                                      or self.above(high) != number - 1):
            middle = (low + high) / 2
            if not low < middle < high:
                break
            low, high = (middle, high) if self.above(middle) >= number else (low, middle)
        return low, high


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a`` shifted to an eigenvalue may be singular to the last bit; any step off it does."""
    try:
        x = np.linalg.solve(a, b)
        if np.isfinite(x).all():
            return x
    except np.linalg.LinAlgError:
        pass
    nudge = np.finfo(float).eps * max(np.abs(a).max(), 1e-300) * len(a)
    return np.linalg.solve(a + nudge * np.eye(len(a)), b)


def _quotient_iteration(v: np.ndarray, low: float, high: float, count: int, start: np.ndarray
                        ) -> tuple[np.ndarray, np.ndarray, bool]:
    """(values, vectors, inside) of the ``count`` eigenvalues between ``low`` and ``high``."""
    eye, scale = np.eye(len(v)), max(abs(high), abs(low), 1e-300)
    # two steps at the middle of the interval bring the wanted vectors to the front
    x = start
    for _ in range(2):
        x = np.linalg.qr(_solved(v - (low + high) / 2 * eye, x))[0]
    values = np.empty(0)
    for _ in range(MAX_ROUNDS):
        small = x.T @ v @ x
        values, turn = np.linalg.eigh((small + small.T) / 2)
        x = x @ turn
        rest = v @ x - x * values
        if np.abs(rest).max() <= 4 * np.finfo(float).eps * scale * len(v):
            break
        x = np.linalg.qr(np.column_stack([
            _solved(v - t * eye, x[:, i]) for i, t in enumerate(values)]))[0]
    inside = bool((values > low).all() and (values <= high).all())
    return values[::-1], x[:, ::-1], inside


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance that are not zero, falling, with unit
    eigenvectors as columns; the largest entry of each is positive."""
    d = len(v)
    bound = float(np.abs(v).sum(1).max()) if d else 0.0  # no eigenvalue is larger
    values, vectors = np.empty(0), np.empty((d, 0))
    if bound == 0.0:
        return values, vectors
    slices = Slices(v)
    least, top = bound * NO_VARIANCE, bound * (1 + 1e-12)
    total = min(wanted, slices.above(least))
    rng = np.random.Generator(np.random.PCG64(1))
    while len(values) < total:
        number = len(values) + 1
        low, high = slices.isolate(number, least, top, TOGETHER * bound)
        for _ in range(MAX_ROUNDS):
            count = slices.above(low) - slices.above(high)
            start = rng.normal(size=(d, count))
            start -= vectors @ (vectors.T @ start)
            e, x, inside = _quotient_iteration(v, low, high, count, start)
            if inside:
                break
            # the iteration went to a neighbour: halve, with the counts as guide
            middle = (low + high) / 2
            low, high = (middle, high) if slices.above(middle) >= number else (low, middle)
        x -= vectors @ (vectors.T @ x)
        vectors = np.column_stack([vectors, np.linalg.qr(x)[0]])
        values = np.concatenate([values, e])
    values, vectors = values[:total], vectors[:, :total]
    certify(slices, values, bound)
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(total)])
    return values, vectors * sign


def certify(slices: Slices, values: np.ndarray, bound: float) -> None:
    """Raise unless value k has k - 1 eigenvalues above it and k from just below it on."""
    slack = 64 * np.finfo(float).eps * bound * len(slices.v)
    for k, e in enumerate(values.tolist(), 1):
        if not slices.above(e + slack) <= k - 1 < slices.above(e - slack):
            raise ArithmeticError(f"eigenvalue {k} is not where it was found")


# ---------------------------------------------------------------- Spark
def prepared(rows: DataFrame) -> DataFrame:
    """Written table (vec_id, x): integer vectors of the rows that are not dropped for a
    null; ``vec_id`` may be null."""
    ship_package(rows.sparkSession)

    def integers(batches):
        for b in batches:
            use, off, x = integer_rows(pa.RecordBatch.from_arrays([b.column(1)], ["e"]), UNIT)
            if len(x) and np.abs(x).max() >= 1 << 40:
                raise ValueError("components are too large for exact sums")
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(use)), packed(x + SHIFT, off)], names=["vec_id", "x"])
    return written_table(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(
        "embedding").cast("array<double>").alias("e")).mapInArrow(
        integers, "vec_id long, x binary"), "integers")


def _blocks(column: pa.Array, dim: int):
    """Integer vectors of a column, some rows at a time."""
    for i in range(0, len(column), SLICE_ROWS):
        part = column.slice(i, SLICE_ROWS)
        yield i, np.frombuffer(b"".join(part.to_pylist()), "<i8").reshape(len(part), dim)


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and sum per dimension, exact."""
    def add(batches):
        n, total = 0, np.zeros(dim, np.int64)
        for b in batches:
            for _, x in _blocks(b.column(0), dim):
                n, total = n + len(x), total + x.sum(0)
        at = np.arange(-1, dim)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(n, total))],
                                         names=["i", "s"])
    got = (fit.select("x").mapInArrow(add, "i long, s long").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    return (int(got[0].s), [int(r.s) for r in got[1:]]) if got else (0, [0] * dim)


def covariance(fit: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """Covariance of the fit list with divisor ``n``: products of whole numbers centred at
    the rounded mean, and what rounding moved the centre taken off exactly."""
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)

    def products(batches):
        gram = np.zeros((dim, dim), np.int64)
        for b in batches:
            for _, x in _blocks(b.column(0), dim):
                y = x - centre
                if len(y) * float(np.abs(y).max(initial=0)) ** 2 < 2 ** 53:
                    f = y.astype(np.float64)
                    part = (f.T @ f).astype(np.int64)
                else:
                    part = y.T @ y
                gram += part
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim)), pa.array(list(gram), pa.list_(pa.int64()))],
            names=["i", "row"])
    # a row of sums per dimension and task; added entry by entry, then one row per dimension
    each = fit.select("x").mapInArrow(products, "i long, row array<long>").select(
        "i", F.posexplode("row").alias("j", "s")).filter("j >= i")
    got = each.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).toArrow()
    v = np.zeros((dim, dim))
    off = [s - n * c for s, c in zip(total, centre.tolist())]
    for i, j, s in zip(*(got[c].to_pylist() for c in ("i", "j", "s"))):
        v[i, j] = v[j, i] = (n * int(s) - off[i] * off[j]) / (n * n)  # whole numbers, one division
    return v


def _whitener(dim: int, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray):
    """Function from integer vectors to ``n * x - total`` (exact) and the whitened vectors."""
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    off = np.array([s - n * c for s, c in zip(total, centre.tolist())], np.int64)
    by = vectors / np.sqrt(values)

    def apply(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x - centre
        if n * (float(np.abs(y).max(initial=0)) + 1) >= 2 ** 62:
            y = y.astype(object)
        away = n * y - off
        return away, (away / n).astype(np.float64) @ by
    return apply


def identity_error(fit: DataFrame, dim: int, n: int, whiten, components: int) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    def products(batches):
        gram, total = np.zeros((components, components)), np.zeros(components)
        for b in batches:
            for _, x in _blocks(b.column(0), dim):
                w = whiten(x)[1]
                gram, total = gram + w.T @ w, total + w.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(components)), pa.array(total),
             pa.array(list(gram), pa.list_(pa.float64()))], names=["i", "t", "row"])
    got = (fit.select("x").mapInArrow(products, "i long, t double, row array<double>")
           .groupBy("i").agg(F.sum("t").alias("t"), *[
               F.sum(F.col("row")[j]).alias(f"g{j}") for j in range(components)])
           .orderBy("i").collect())
    mean = np.array([r.t for r in got]) / n
    gram = np.array([r[2:] for r in got], np.float64) / n - np.outer(mean, mean)
    return float(np.abs(gram - np.eye(components)).max())


def _deviations(away: np.ndarray) -> pa.Array:
    """Sums of squares, exact; null beyond 64 bits."""
    about = (away.astype(np.float64) ** 2).sum(1)
    if away.dtype != object and (about < 2 ** 62).all():
        return pa.array((away * away).sum(1))
    return pa.array([d if a < 2.0 ** 63 * 1.001 and (d := sum(int(c) ** 2 for c in row)) < 2 ** 63
                     else None for a, row in zip(about.tolist(), away)], pa.int64())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per row and component, see ``OUT``."""
    spark = rows.sparkSession
    table = prepared(rows)
    size = table.agg(F.max(F.length("x"))).first()[0] or 0
    table, dim = table.filter(F.length("x") == size), size // 8
    fit = written_table(table.select("x").distinct(), "fit")
    n, total = sums(fit, dim) if dim else (0, [])
    values, vectors = (leading(v := covariance(fit, dim, n, total), components) if n
                       else (np.empty(0), np.empty((0, 0))))
    k = len(values)
    if not k:
        return spark.createDataFrame([], OUT)
    share = values / np.trace(v)
    whitener = _whitener(dim, n, total, values, vectors)
    error = identity_error(fit, dim, n, whitener, k)

    def apply(batches):
        for b in batches:
            for lo, x in _blocks(b.column(1), dim):
                away, w = whitener(x)
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(x)).take(at),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, n)), _deviations(away).take(at),
                     pa.array(w.reshape(-1)), pa.array(np.tile(share, len(x))),
                     pa.array(np.full(len(x) * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])
    return table.select("vec_id", "x").mapInArrow(apply, OUT)
