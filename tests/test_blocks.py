"""Half steps over packed blocks of ratings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold import config
from rankfold.operators import als, blocks


def _rows(spark, users=40, items=30, n=500):
    """Residual rows with repeated pairs and ids of both signs."""
    rng = np.random.default_rng(7)
    u, i = rng.integers(0, users, n) - 5, rng.integers(0, items, n) * 3_000_000_000
    rows = spark.createDataFrame(
        [(int(a), int(b), float(r), float(y)) for a, b, r, y in zip(
            u, i, rng.integers(1, 11, n) / 2, rng.normal(size=n))],
        "user_id long, item_id long, rating double, y double")
    for c, k in (("user_id", "n_u"), ("item_id", "n_i")):
        rows = rows.join(rows.groupBy(c).agg(F.count(F.lit(1)).alias(k)), c)
    return rows.checkpoint()


def _packed(spark, rows, side, max_rows):
    how = blocks.plan(spark, rows.count(), 40, 3, max_rows)
    return how, blocks.pack(rows, side, how, als._checkpoint, als._partitioned_checkpoint)


@pytest.mark.parametrize("side", ["user", "item"])
@pytest.mark.parametrize("max_rows", [200_000, 9])
def test_packed_half_step_equals_numpy(spark, side, max_rows, monkeypatch):
    monkeypatch.setattr(blocks, "PIECE_BYTES", 50)
    rows = _rows(spark)
    me, other, _, n_other = blocks.SIDES[side]
    how, packed = _packed(spark, rows, side, max_rows)
    fixed = rows.select(other, F.col(n_other).alias("n")).distinct().select(
        other, "n", als._start(other, 3))
    st = blocks.stage(packed, blocks.pack_factors(fixed, other, how), 3, 0.1, True).checkpoint()
    got = {r[me]: r.factors for r in blocks.unpack_factors(
        st.filter("ids is not null"), me, 3).collect()}
    split = {r[me]: r.factors for r in blocks.split_factors(st, me, 3, 0.1).collect()}
    assert bool(split) == (max_rows == 9) and not got.keys() & split.keys()
    q = {r[other]: np.array(r.factors) for r in fixed.collect()}
    pdf = rows.toPandas()
    se = objective = 0.0
    assert got.keys() | split.keys() == set(pdf[me])
    for k, g in pdf.groupby(me):
        x, y = np.stack([q[o] for o in g[other]]), g["y"].to_numpy()
        want = np.linalg.solve(x.T @ x + 0.1 * len(g) * np.eye(3), x.T @ y)
        np.testing.assert_allclose((got | split)[k], want, rtol=1e-9, atol=1e-12)
        if k in got:
            d, r = x @ want, g["rating"].to_numpy()
            se += ((r - np.clip(r - y + d, config.CLIP_LO, config.CLIP_HI)) ** 2).sum()
            objective += ((y - d) ** 2).sum() + 0.1 * ((x * x).sum() + len(g) * want @ want)
    found = st.agg(F.sum("se"), F.sum("objective")).first()
    np.testing.assert_allclose(list(found), [se, objective], rtol=1e-9)


def test_a_factor_travels_once_per_block_and_ratings_stay(spark):
    rows = _rows(spark)
    how, packed = _packed(spark, rows, "user", 200_000)
    assert len(how.labels) >= 8
    fixed = blocks.pack_factors(rows.select("item_id", F.col("n_i").alias("n")).distinct().select(
        "item_id", "n", als._start("item_id", 3)), "item_id", how)
    sent = blocks.pieces(fixed, packed, 3).select(
        F.sum(F.octet_length("factors") / 24)).first()[0]
    pairs = rows.select(how.block("user_id", F.lit(0).cast("long")), "item_id").distinct().count()
    assert sent == pairs < 500
    # every block is a partition of its own, and no exchange stands above the ratings
    assert packed.ratings.select(F.spark_partition_id()).distinct().count() == len(how.labels)
    plan = blocks.stage(packed, fixed, 3, 0.1, False)._jdf.queryExecution().executedPlan(
        ).toString().split("\n")
    scan = next(i for i, line in enumerate(plan) if "Scan" in line and "whole#" in line)
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    assert not [line for line in plan[:scan]
                if len(line) - len(line.lstrip(" :+-")) < depth and "Exchange" in line]


def test_blocks_keep_many_cores_busy_and_are_bounded():
    # the feedback of 60 times sf0.1: two blocks of 5 million would keep two cores busy
    assert -(-8_700_000 // blocks.block_rows(8_700_000, 1_200_000, 20)) >= 16
    for ratings, entities in ((32_400_000, 1_200_000), (194_000_000, 7_200_000), (10 ** 9, 10 ** 8)):
        n = blocks.block_rows(ratings, entities, 20)
        wanted = entities * (1 - np.exp(-n / entities))
        assert wanted * 8 * 20 <= config.FIT_BLOCK_BYTES * 1.001


def test_a_large_fit_goes_by_blocks(spark, monkeypatch):
    used = []
    monkeypatch.setattr(als.config, "MAX_FACTOR_BROADCAST_BYTES", 0)
    monkeypatch.setattr(blocks, "stage", lambda p, *a, make=blocks.stage, **k: (
        used.append(p.ratings.count()), make(p, *a, **k))[1])
    als.fit_exact(_rows(spark), rank=2, iterations=1, history=False)
    assert len(used) == 2 and min(used) >= 8


@pytest.mark.parametrize("max_rows", [200_000, 9])
def test_second_half_step_shuffles_no_vector_per_rating(spark, max_rows, monkeypatch):
    rows = _rows(spark)
    p = als.half_step(rows, None, "user", 3, max_rows=max_rows)
    want = {r.item_id: r for r in als.second_half_step(rows, p, "item", 3).collect()}
    monkeypatch.setattr(als.config, "MAX_FACTOR_BROADCAST_BYTES", 0)
    monkeypatch.setattr(als, "half_step", None)  # which joins the vectors to the ratings
    got = {r.item_id: r for r in als.second_half_step(
        rows, p, "item", 3, max_rows=max_rows).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k].n == w.n
        np.testing.assert_allclose(got[k].factors, w.factors, rtol=1e-9, atol=1e-12)


def test_a_rating_without_a_factor_is_an_error(spark):
    rows = _rows(spark)
    how, packed = _packed(spark, rows, "user", 200_000)
    some = rows.filter("item_id > 0").select("item_id", F.col("n_i").alias("n")).distinct().select(
        "item_id", "n", als._start("item_id", 3))
    with pytest.raises(Exception, match="no factor"):
        blocks.pieces(blocks.pack_factors(some, "item_id", how), packed, 3).collect()
