"""Whitening against plain linear algebra in exact and double arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from rankfold.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, components=16):
    """(n, {vec_id: (deviation, whitened)}, eigenvalues, explained) by exact sums and eigh."""
    kept = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(x) for _, x in kept)
    kept = [(i, x) for i, x in kept if len(x) == dim]
    fit = sorted({x for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    away = [[n * c - t for c, t in zip(x, s)] for x in fit]
    v = np.array([[float(Fraction(sum(a[i] * a[j] for a in away), n ** 3)) for j in range(dim)]
                  for i in range(dim)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return n, [(i, sum((n * c - t) ** 2 for c, t in zip(x, s)),
                np.array([(n * c - t) / n for c, t in zip(x, s)]) @ (u / np.sqrt(e)))
               for i, x in kept], e, e / np.trace(v)


def compare(got, rows, components=16):
    n, want, e, share = brute(rows, components)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(want) * len(e)
    sign = None
    for i, deviation, w in want:
        own = [by[i][k + 1] for k in range(len(e))]
        assert {r.n for r in own} == {n} and {r.deviation for r in own} == {deviation}
        x = np.array([r.whitened for r in own])
        sign = np.sign(x * w) if sign is None else sign
        assert x * sign == pytest.approx(w, abs=1e-6)
        assert [r.explained for r in own] == pytest.approx(list(share), rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def test_matches_plain_algebra(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 24)) * np.linspace(3, 0.2, 24)
    rows = [(i, list(map(float, v)), 1) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(90)]  # fitted once
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    compare(got, rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    compare(whitening.whiten(df).collect(), rows)


def test_edges(spark):
    rows = [(1, [1.0, 2.0, 0.5], 1), (2, [0.0, 1.0, 0.25], None), (3, None, 1),
            (4, [1.0, None, 1.0], 1), (5, [float("nan"), 1.0, 1.0], 1), (6, [1.0, 2.0], 1),
            (7, [0.5, -3.0, 1.0], 1), (8, [2.0, 0.0, 1.5], 2), (9, [], 1),
            (11, [float("-inf"), 1.0, 1.0], 1), (12, [1.5, 1.5, -7.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    compare(whitening.whiten(df).collect(), rows)
    from pyspark.sql import functions as F
    clash = df.select("*", *[F.lit("y").alias(c) for c in ("x", "e", "n", "component", "i", "s")])
    compare(whitening.whiten(clash).collect(), rows)
    nobody = spark.createDataFrame([(None, [1.0, 9.0, 4.0], 1)], SCHEMA)
    got = whitening.whiten(df.unionByName(nobody)).filter("vec_id is null").collect()
    assert [r.component for r in got] == [1, 2, 3]
    empty = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and len(empty.columns) == 7
    one = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    assert whitening.whiten(one).count() == 0  # no variance, no component


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), float(-i), 1.0, float(i % 5)], 1) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}
    assert got[0].identity_error < 1e-9
    assert sum(r.explained for r in got if r.vec_id == 3) == pytest.approx(1.0)


def test_deviations_are_exact_up_to_64_bits():
    rows = [[3, -4], [2 ** 31, 2 ** 31], [3037000499, 0], [3037000500, 0], [2 ** 40, 5]]
    want = [sum(c * c for c in r) for r in rows]
    want = [w if w < 2 ** 63 else None for w in want]
    assert want.count(None) == 3
    assert whitening._deviations(np.array(rows, np.int64)).to_pylist() == want
    assert whitening._deviations(np.array(rows, object)).to_pylist() == want
    assert whitening._deviations(np.array(rows[:1], np.int64)).to_pylist() == [25]


def test_counts_equal_those_of_the_eigenvalues():
    rng = np.random.default_rng(5)
    for n in range(1, 30):
        for _ in range(12):
            a = rng.integers(-3, 4, (n, n)).astype(float)
            a = a + a.T
            if rng.random() < 0.5:
                np.fill_diagonal(a, 0)
            e = np.linalg.eigvalsh(a)
            for shift in (*rng.normal(size=3) * 3, 0.37):
                assert whitening.positive_pivots(a - shift * np.eye(n)) == (e > shift).sum()


@pytest.mark.parametrize("kind", ["wide", "close", "equal", "one", "tiny"])
def test_leading_eigenvalues(kind):
    rng = np.random.default_rng(8)
    e = {"wide": 10.0 ** -np.arange(20), "close": 1 + 1e-7 * np.arange(20)[::-1],
         "equal": np.repeat([5.0, 2.0, 1.0], [4, 9, 7]), "one": np.append(3.0, np.zeros(19)),
         "tiny": 1e-30 * np.arange(20, 0, -1)}[kind]
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    v = q * e @ q.T
    v = (v + v.T) / 2
    got, x = whitening.leading(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:len(got)]
    assert len(got) == {"wide": len(got), "one": 1}.get(kind, 16) and len(got) >= 1
    assert np.abs(got - want).max() <= 1e-13 * e[0] * 20
    assert np.abs(x.T @ x - np.eye(len(got))).max() < 1e-12
    assert np.abs(v @ x - x * got).max() < 1e-12 * e[0]
