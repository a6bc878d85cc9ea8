"""Least-squares half steps, exact loop and MLlib fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold.operators import als, bias, evaluate, split


def _synthetic(spark, seed=0, users=50, items=40, n=1000):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(users, 2)), rng.normal(size=(items, 2))
    pairs = rng.choice(users * items, size=n, replace=False)
    rows = []
    for p in pairs:
        u, i = divmod(int(p), items)
        r = float(np.clip(3 + 0.9 * a[u] @ b[i] + rng.normal(0, 0.1), 0.5, 5.0))
        rows.append((u, i, r))
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def _residual_rows(tr):
    mu = bias.global_mean(tr)
    ub = bias.user_bias(tr, mu)
    ib = bias.item_bias(tr, mu, ub)
    return mu, ub, ib, bias.residuals(tr, mu, ub, ib)


def _numpy_half_step(rows_pdf, fixed, me, other, reg):
    out = {}
    for k, g in rows_pdf.groupby(me):
        x = np.stack([fixed[o] for o in g[other]])
        a = x.T @ x + reg * len(g) * np.eye(x.shape[1])
        out[k] = np.linalg.solve(a, x.T @ g["y"].to_numpy())
    return out


@pytest.mark.parametrize("max_rows", [200_000, 3])
def test_half_step_matches_numpy_and_salting_is_exact(spark, max_rows):
    tr = _synthetic(spark, n=400)
    _, _, ib, rows = _residual_rows(tr)
    q0 = als.init_factors(ib.select("item_id"), "item_id", 3)
    fixed = {r.item_id: np.array(r.factors) for r in q0.collect()}
    got = {r.user_id: np.array(r.factors)
           for r in als.half_step(rows, q0, "user", 3, 0.1, max_rows=max_rows).collect()}
    want = _numpy_half_step(rows.toPandas(), fixed, "user_id", "item_id", 0.1)
    assert set(got) == set(want)
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("max_rows", [200_000, 5])
@pytest.mark.parametrize("side", ["user", "item"])
def test_routed_half_step_equals_the_shuffled_one(spark, side, max_rows):
    tr = _synthetic(spark, n=900)
    _, ub, ib, rows = _residual_rows(tr)
    me, other = als.SIDES[side][:2]
    ids = ib if side == "user" else ub
    fixed = als.init_factors(ids.select(other), other, 3)
    want = {r[me]: (r.n, np.array(r.factors)) for r in als.half_step(
        rows, fixed, side, 3, 0.1, max_rows=max_rows).collect()}
    r = als.routing(rows, side, max_rows, block_rows=200)
    assert r.ratings.select("_block").distinct().count() > 2
    got = {x[me]: (x.n, np.array(x.factors)) for x in als.half_step(
        rows, fixed, side, 3, 0.1, max_rows, r).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        np.testing.assert_allclose(got[k][1], want[k][1], rtol=1e-9, atol=1e-12)


def test_routing_sends_a_factor_once_per_block_and_no_ratings(spark):
    tr = _synthetic(spark, users=60, items=12, n=700)
    _, ub, ib, rows = _residual_rows(tr)
    r = als.routing(rows, "user", block_rows=200)
    pairs = r.ratings.select("_block", "item_id").distinct().count()
    fixed = als.init_factors(ib.select("item_id"), "item_id", 3)
    assert als.routed_factors(fixed, r, "item_id").count() == pairs == r.routes.count() < 60
    stage = als._routed_stage(r, fixed, "user", 3, 0.1, True)
    plan = stage._jdf.queryExecution().executedPlan().toString().split("\n")
    # the ratings (the rows with y) are read in place: no exchange above their scan
    scan = next(i for i, line in enumerate(plan) if "Scan" in line and " y#" in line.replace(",", " "))
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    above = [line for line in plan[:scan]
             if len(line) - len(line.lstrip(" :+-")) < depth and "Exchange" in line]
    assert not above


def test_fit_by_routing_equals_fit_by_broadcast(spark, monkeypatch):
    tr = _synthetic(spark, n=500)
    a = als.fit_exact(tr, rank=2, iterations=2)
    monkeypatch.setattr(als.config, "MAX_FACTOR_BROADCAST_BYTES", 0)
    b = als.fit_exact(tr, rank=2, iterations=2)
    x = {r.item_id: np.array(r.factors) for r in a.item_factors.collect()}
    y = {r.item_id: np.array(r.factors) for r in b.item_factors.collect()}
    assert x.keys() == y.keys()
    for k in x:
        np.testing.assert_allclose(x[k], y[k], rtol=1e-8, atol=1e-10)
    assert [r.train_rmse for r in a.history.collect()] == pytest.approx(
        [r.train_rmse for r in b.history.collect()])


def test_normal_equations_partials_sum(spark):
    tr = _synthetic(spark, n=300)
    _, _, ib, rows = _residual_rows(tr)
    q0 = als.init_factors(ib.select("item_id"), "item_id", 2)
    a = {r.user_id: (r.n, r.xtx, r.xty) for r in als.normal_equations(rows, q0, "user", 2).collect()}
    b = {r.user_id: (r.n, r.xtx, r.xty)
         for r in als.normal_equations(rows, q0, "user", 2, max_rows=2).collect()}
    for k in a:
        assert a[k][0] == b[k][0]
        np.testing.assert_allclose(a[k][1], b[k][1], rtol=1e-12)
        np.testing.assert_allclose(a[k][2], b[k][2], rtol=1e-12, atol=1e-15)


def test_exact_objective_never_rises_and_beats_bias_only(spark):
    df = _synthetic(spark, seed=1)
    tr, ho = split.train_holdout(df, method="xxhash")
    m = als.fit_exact(tr, rank=2, iterations=6)
    obj = [r.objective for r in m.history.orderBy("iteration").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(obj, obj[1:]))
    full = evaluate.eval_summary(ho, m).first()
    base = evaluate.bias_only_summary(ho, m).first()
    assert full.rmse < base.rmse


def test_mllib_matches_weighted_lambda_normal_equations(spark):
    df = _synthetic(spark, seed=2)
    m = als.fit_mllib(df, rank=3, iterations=10, reg=0.1)
    mu, ub, ib, rows = _residual_rows(df)
    # the side solved last (items) must satisfy its normal equations exactly
    p = {r.user_id: np.array(r.factors) for r in m.user_factors.collect()}
    want = _numpy_half_step(rows.toPandas(), p, "item_id", "user_id", 0.1)
    got = {r.item_id: np.array(r.factors) for r in m.item_factors.collect()}
    err = max(np.abs(got[k] - want[k]).max() for k in want)
    assert err < 1e-4


def test_fold_in_equals_user_half_step(spark):
    df = _synthetic(spark, seed=3)
    m = als.fit_exact(df, rank=2, iterations=2, history=False)
    new = df.filter("user_id < 5").withColumn("user_id", F.col("user_id") + 1000)
    f = {r.user_id: r for r in als.fold_in(new, m).collect()}
    assert set(f) == {1000, 1001, 1002, 1003, 1004}
    q = m.item_factors.select("item_id", "factors")
    b_i = {r.item_id: r.bias for r in m.item_factors.collect()}
    rows = new.toPandas()
    rows["y"] = [r.rating - m.mu - f[r.user_id].bias - b_i[r.item_id] for r in rows.itertuples()]
    want = _numpy_half_step(rows, {r.item_id: np.array(r.factors) for r in q.collect()},
                            "user_id", "item_id", m.reg)
    for u, r in f.items():
        np.testing.assert_allclose(r.factors, want[u], rtol=1e-9, atol=1e-12)


def test_optimality_tells_solved_from_unsolved(spark):
    df = _synthetic(spark, seed=4)
    m = als.fit_exact(df, rank=2, iterations=2, history=False)
    _, _, _, rows = _residual_rows(df)
    ok = als.optimality(rows, m.user_factors, m.item_factors, "item", 2).collect()
    assert max(r.max_error for r in ok) < 1e-9
    off = m.item_factors.withColumn("factors", F.transform("factors", lambda x: x + 0.01))
    bad = als.optimality(rows, m.user_factors, off, "item", 2).collect()
    assert min(r.max_error for r in bad) > 1e-4


def test_non_finite_input_is_an_error(spark):
    df = _synthetic(spark, seed=4)
    _, _, ib, rows = _residual_rows(df)
    q0 = als.init_factors(ib.select("item_id"), "item_id", 2)
    with pytest.raises(Exception, match="non-finite"):
        als.half_step(rows.withColumn("y", F.lit(float("nan"))), q0, "user", 2, 0.1)


def test_mllib_ids_beyond_int32_are_remapped(spark):
    df = _synthetic(spark, seed=5, users=12, items=10, n=80).select(
        (F.col("user_id") + 3_000_000_000).alias("user_id"),
        (F.col("item_id") + 5_000_000_000).alias("item_id"), "rating")
    m = als.fit_mllib(df, rank=2, iterations=3)
    users = {r.user_id for r in m.user_factors.collect()}
    items = {r.item_id for r in m.item_factors.collect()}
    assert users == {r.user_id for r in df.select("user_id").distinct().collect()}
    assert items == {r.item_id for r in df.select("item_id").distinct().collect()}
    assert all(len(r.factors) == 2 for r in m.item_factors.collect())


def test_laid_out_half_step_moves_no_rating_rows(spark):
    tr = _synthetic(spark, seed=6, n=200)
    _, _, ib, rows = _residual_rows(tr)
    rows = rows.checkpoint()
    q0 = als.init_factors(ib.select("item_id"), "item_id", 2).checkpoint()
    lo = als.layout(rows, "user").checkpoint()
    st = als._stage(rows, q0, "user", 2, 0.1, True, 200_000, lo)
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    a = {r.user_id: r.factors for r in als.half_step(rows, q0, "user", 2, 0.1).collect()}
    b = {r.user_id: r.factors for r in als.half_step(rows, q0, "user", 2, 0.1, laid_out=lo)
         .collect()}
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=1e-12, atol=1e-15)


def test_singular_systems_fall_back_and_others_do_not(spark):
    """Without regularisation: plain solution where there is one, else 0.01 on the diagonal."""
    tr = _synthetic(spark, users=40, items=30, n=220)
    _, _, ib, rows = _residual_rows(tr)
    q0 = als.init_factors(ib.select("item_id"), "item_id", 6)
    fixed = {r.item_id: np.array(r.factors) for r in q0.collect()}
    got = {r.user_id: np.array(r.factors)
           for r in als.half_step(rows, q0, "user", 6, 0.0, max_rows=4).collect()}
    weak = 0
    for u, g in rows.toPandas().groupby("user_id"):
        x = np.stack([fixed[i] for i in g["item_id"]])
        short = np.linalg.matrix_rank(x) < 6
        weak += short
        a = x.T @ x + (0.01 * np.eye(6) if short else 0)
        np.testing.assert_allclose(a @ got[u], x.T @ g["y"].to_numpy(), atol=1e-9)
    assert 5 < weak < len(got)
    zero = als._solve_unregularised(np.zeros((2, 3, 3)), np.zeros((2, 3)))
    assert (zero == 0).all()
    huge = als._solve_unregularised(np.array([np.eye(2) * 1e-320]), np.array([[1e300, 1.0]]))
    assert np.isfinite(huge).all()
    with pytest.raises(ValueError):
        als.half_step(rows, q0, "user", 6, -0.1)


def test_errors_from_the_blocks_equal_those_of_joined_rows(spark, monkeypatch):
    """The history, whether or not items are split, without a join of all rows to factors."""
    tr = _synthetic(spark, n=600)
    want = als.fit_exact(tr, rank=2, iterations=2).history.collect()
    monkeypatch.setattr(als.config, "MAX_FACTOR_BROADCAST_BYTES", 0)
    monkeypatch.setattr(als, "routing", lambda rows, side, max_rows, make=als.routing: make(
        rows, side, max_rows, block_rows=150))
    joined = []
    monkeypatch.setattr(als, "train_errors", lambda rows, *a, make=als.train_errors, **k: (
        joined.append(rows.count()), make(rows, *a, **k))[1])
    for max_rows in (200_000, 12):
        got = als.fit_exact(tr, rank=2, iterations=2, max_rows=max_rows).history.collect()
        for c in ("train_rmse", "objective"):
            assert [r[c] for r in got] == pytest.approx([r[c] for r in want], rel=1e-9)
        # only ratings of split items are joined
        assert (not joined) if max_rows > 600 else 0 < max(joined) < 600


def test_factors_of_two_million_entities_are_not_broadcast(spark):
    n = 900_000 + 1_200_000
    assert als.factor_bytes(n, 20) > als.config.MAX_FACTOR_BROADCAST_BYTES


def test_start_factors_do_not_travel(spark):
    tr = _synthetic(spark, n=300)
    _, _, ib, rows = _residual_rows(tr)
    q0 = als.init_factors(ib.select("item_id"), "item_id", 3)
    plan = als._stage(rows, None, "user", 3, 0.1, True, 200_000)._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert "factors" not in plan[plan.index("RepartitionByExpression"):]
    want = {r.user_id: r.factors for r in als.half_step(rows, q0, "user", 3).collect()}
    got = {r.user_id: r.factors for r in als.half_step(rows, None, "user", 3).collect()}
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-12)


def test_mllib_blocks_follow_the_ratings_not_the_session(spark, monkeypatch):
    from pyspark.ml import recommendation
    made, fit = [], recommendation.ALS.fit
    monkeypatch.setattr(recommendation.ALS, "fit", lambda self, rows: (
        made.append((self.getNumUserBlocks(), self.getNumItemBlocks())), fit(self, rows))[1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        als.fit_mllib(_synthetic(spark, n=200), rank=2, iterations=1)
        monkeypatch.setattr(als.config, "MLLIB_BLOCK_ROWS", 15)
        als.fit_mllib(_synthetic(spark, n=200), rank=2, iterations=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made == [(10, 10), (14, 14)]
