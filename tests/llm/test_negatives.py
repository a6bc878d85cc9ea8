"""Hard negatives against a plain search, and the certificate of the walks."""

import math
import random

import numpy as np
import pytest

from rankfold.llm import negatives
from tests.llm.conftest import all_rows

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """Plain search over (vec_id, vector, label) rows with unique ids."""
    kept = []
    for i, v, y in rows:
        if i is None or v is None or y is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * c) for c in v]))
    out = []
    for a, y, u in kept:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(u, v)), i, z) for i, z, v in kept if i != a)
        for s, p, _ in [x for x in scored if x[2] == y][:5]:
            fit = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit)]
    return sorted(out, key=repr)


def clustered(n, dim, seed, spread=0.15):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(12, dim))
    x = heads[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    x *= rng.uniform(0.3, 1.5, (n, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    return x


@pytest.mark.parametrize("cells,step", [(1 << 22, 1024), (900, 16)])
def test_matches_plain_search(spark, monkeypatch, cells, step):
    monkeypatch.setattr(negatives, "BLOCK_CELLS", cells)
    monkeypatch.setattr(negatives, "ANCHOR_CELLS", cells // 10)
    monkeypatch.setattr(negatives, "STEP", step)
    rng = random.Random(3)
    x = clustered(900, 8, 1)
    rows = [(i, list(map(float, v)), rng.randint(0, 4)) for i, v in enumerate(x)]
    # equal vectors under many ids, ties, and scores of zero and below
    rows += [(2000 + i, rows[5][1], i % 3) for i in range(60)]
    rows += [(3000, [0.0] * 8, 1), (3100, [-c for c in rows[100][1]], 2)]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert all_rows(got) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, 0.5], 0), (100, None, 1), (200, [1.0, None], 1), (300, [1.0, float("nan")], 1),
            (400, [float("inf"), 1.0], 1), (500, [0.5, 0.5], None), (None, [1.0, 1.0], 1),
            (1, [1.0, 0.5], 1), (2, [0.9, 0.4], 2), (3, [0.8, 0.5], 3), (600, [1.0], 2),
            (601, [], 2), (602, [0.9, 0.0, 0.1], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert all_rows(negatives.mine(df)) == brute(rows)
    from pyspark.sql import functions as F
    clash = df.select("*", *[F.lit("x").alias(c) for c in (
        "v", "norm", "deal", "anchor", "b", "g", "score", "id", "place", "low", "high")])
    assert all_rows(negatives.mine(clash)) == brute(rows)
    empty = negatives.mine(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_repeated_rows(spark):
    """As anchors once; as positives and negatives as often as they occur."""
    rows = [(100, [1.0, 0.0], 1)] * 3 + [(1, [1.0, 0.1], 1)] * 2 + [(2, [0.9, 0.1], 2)] * 2
    got = all_rows(negatives.mine(spark.createDataFrame(rows, SCHEMA)))
    s = 256 * 256
    t = 256 * math.floor(256 * 0.9)
    assert got == sorted([(100, 1, k, 2, s, t) for k in (1, 2)] * 2, key=repr)


def test_walks_end_early_and_bounds_hold(monkeypatch):
    """On clustered directions most of every list is certified unseen."""
    monkeypatch.setattr(negatives, "STEP", 64)
    x = np.floor(256 * clustered(6000, 16, 4, 0.05))
    ids, label = np.arange(6000), np.zeros(6000, np.int64)

    def part(w):
        return {"x": x[w], "norm": np.sqrt((x[w] ** 2).sum(1)), "id": ids[w], "label": label[w]}
    anchors, rows = part(ids[::100]), part(ids)
    c = negatives.fit_centroids(anchors["x"], 12)
    wanted = negatives.Wanted(np.full((1, 60), -np.inf), np.full((1, 60), np.inf), True, 5)
    done = negatives.walk(anchors, rows, c, wanted)
    scores = anchors["x"] @ x.T
    for a in range(60):
        scores[a, anchors["id"][a]] = -np.inf
        best = np.lexsort((ids, -scores[a]))[:5]
        own = wanted.slot == a
        assert sorted(wanted.id[own]) == sorted(best)
    assert done < 0.35 * scores.size


def test_given_table_matches_plain_search(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = all_rows(negatives.mine(df))
    assert got and got == brute(rows)
