"""Driver contract, model round trip and the dense index."""

import os

import pytest

import __spark_entry__ as E
from conftest import RATING_SCHEMA, ts
from rankfold.model import load_model, read_current_pointer, retrain, save_model
from rankfold.operators import als, profile
from rankfold.plans.oracle import oracle_sql
from rankfold.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["user_id", "source", "rank", "item_id", "title"]
    assert len(rows) > 0
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_user.values())


def test_every_core_query_has_an_oracle():
    from rankfold.plans.catalog import QUERIES
    assert set(QUERIES) == set(oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_retrain_writes_versions_and_moves_the_pointer(spark, tmp_path):
    rows = [(u, i, float(1 + (u * i) % 9) / 2, ts(u, i), u * 100 + i)
            for u in range(30) for i in range(20)]
    base = spark.createDataFrame(rows[:400], RATING_SCHEMA)
    fb = spark.createDataFrame(rows[380:], RATING_SCHEMA)
    out = str(tmp_path)
    a = retrain(base, fb, out, version="v1", rank=2, iterations=2).first()
    assert a.promote and a.old_rmse is None and read_current_pointer(spark, out) == "v1"
    m = load_model(spark, f"{out}/v1")
    assert (m.n_train, m.rmse, m.mae) == (a.n_train, a.new_rmse, a.new_mae)
    assert a.n_train + a.n_eval + a.n_skipped == 600
    assert spark.read.parquet(f"{out}/v1/predictions").count() == a.n_eval
    b = retrain(base, fb, out, version="v2", rank=2, iterations=1, max_rmse_increase=-9.0).first()
    assert not b.promote and b.old_rmse == pytest.approx(a.new_rmse)
    assert read_current_pointer(spark, out) == "v1"
    c = retrain(None, fb, out, feedback_only=True, version="v3", rank=2, iterations=1,
                max_rmse_increase=9.0).first()
    assert c.promote and read_current_pointer(spark, out) == "v3"


def test_model_round_trip_and_dense_index(spark):
    df = spark.createDataFrame([(u, i, float(1 + (u * i) % 9) / 2) for u in range(8)
                                for i in range(6)], "user_id long, item_id long, rating double")
    m = als.fit_exact(df, rank=2, iterations=1)
    path = scratch_path(spark, "m")
    save_model(m, path)
    back = load_model(spark, path)
    assert back.mu == pytest.approx(m.mu) and back.rank == 2
    a = sorted((r.item_id, tuple(r.factors)) for r in m.item_factors.collect())
    b = sorted((r.item_id, tuple(r.factors)) for r in back.item_factors.collect())
    assert a == b
    ids = spark.createDataFrame([(x,) for x in (50, 7, 3_000_000_000, 7, 12)], "id long")
    idx = sorted((r.id, r.id_idx) for r in profile.dense_index(ids, "id", 3).collect())
    assert idx == [(7, 0), (12, 1), (50, 2), (3_000_000_000, 3)]
