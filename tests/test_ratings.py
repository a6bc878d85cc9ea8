"""Validation, merge, split and bias operators on hand-made rows."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import EVENT_SCHEMA, RATING_SCHEMA, ts
from rankfold.operators import bias, clean, merge, profile, split


def test_nulls_and_range_rejected(spark):
    rows = [(None, 1, 3.0, ts(0), 1), (1, None, 3.0, ts(0), 2), (1, 2, None, ts(0), 3),
            (1, 3, 0.0, ts(0), 4), (1, 4, 0.4, ts(0), 5), (1, 5, 5.1, ts(0), 6),
            (1, 6, 0.5, ts(0), 7), (1, 7, 5.0, ts(0), 8)]
    df = spark.createDataFrame(rows, RATING_SCHEMA)
    valid = {r.item_id for r in clean.valid_ratings(df).collect()}
    assert valid == {6, 7}
    rej = {(r.seq, r.reason) for r in clean.rating_rejects(df).collect()}
    assert rej == {(1, "null_user"), (2, "null_item"), (3, "missing_rating"),
                   (4, "below_range"), (5, "below_range"), (6, "above_range")}


def test_feedback_beats_newer_base_and_last_feedback_wins(spark):
    base = spark.createDataFrame([(1, 10, 1.0, ts(9), 1), (2, 20, 3.0, ts(0), 1)], RATING_SCHEMA)
    fb = spark.createDataFrame([(1, 10, 4.0, ts(1), 5),   # older than base row, still wins
                                (2, 20, 2.0, ts(2), 6), (2, 20, 5.0, ts(3), 7)], RATING_SCHEMA)
    m = {(r.user_id, r.item_id): (r.rating, r.source)
         for r in merge.merge_ratings(base, fb).collect()}
    assert m == {(1, 10): (4.0, "feedback"), (2, 20): (5.0, "feedback")}


def test_feedback_only_still_deduplicates(spark):
    fb = spark.createDataFrame([(1, 10, 4.0, ts(1), 5), (1, 10, 2.0, ts(2), 6)], RATING_SCHEMA)
    out = merge.merge_ratings(None, fb, feedback_only=True).collect()
    assert [(r.rating) for r in out] == [2.0]


def test_merge_is_idempotent(spark):
    base = spark.createDataFrame([(u, i, float(1 + (u + i) % 9) / 2, ts(u), u * 10 + i)
                                  for u in range(5) for i in range(4)], RATING_SCHEMA)
    once = merge.merge_ratings(base, None)
    twice = merge.merge_ratings(once.drop("source"), None)
    a = sorted(tuple(r) for r in once.select("user_id", "item_id", "rating").collect())
    b = sorted(tuple(r) for r in twice.select("user_id", "item_id", "rating").collect())
    assert a == b


def test_split_stable_under_repartitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97).alias("user_id"),
                                     (F.col("id") % 89).alias("item_id"),
                                     F.lit(3.0).alias("rating"))
    for method in ("linear", "xxhash"):
        a = split.with_holdout_flag(df, method=method).filter("is_holdout")
        b = split.with_holdout_flag(df.repartition(7), method=method).filter("is_holdout")
        ka = sorted((r.user_id, r.item_id) for r in a.collect())
        kb = sorted((r.user_id, r.item_id) for r in b.collect())
        assert ka == kb and 0 < len(ka) < 2000


def test_single_rating_user_bias(spark):
    tr = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (2, 2, 1.0)],
                               "user_id long, item_id long, rating double")
    mu = bias.global_mean(tr)
    assert mu == pytest.approx(3.0)
    ub = {r.user_id: r.bias for r in bias.user_bias(tr, mu).collect()}
    assert ub[1] == pytest.approx((5.0 - 3.0) / 11)
    assert ub[2] == pytest.approx((0.0 + -2.0) / 12)
    ib = {r.item_id: r.bias for r in bias.item_bias(tr, mu, bias.user_bias(tr, mu)).collect()}
    assert ib[2] == pytest.approx((1.0 - 3.0 - ub[2]) / 11)


def test_empty_ratings_raise(spark):
    empty = spark.createDataFrame([], "user_id long, item_id long, rating double")
    with pytest.raises(ValueError):
        bias.global_mean(empty)


def test_split_takes_the_fraction_it_is_given(spark):
    df = spark.range(0, 40000).select((F.col("id") * 10).alias("user_id"),
                                      (F.col("id") % 50 * 10 + 2 ** 60).alias("item_id"))
    for fraction in (0.05, 0.15, 0.25):
        n = split.with_holdout_flag(df, fraction).filter("is_holdout").count()
        assert abs(n / 40000 - fraction) < 0.01
    split.with_holdout_flag(df, 0.1, "linear").count()  # large ids do not overflow
    for bad, method in ((0.0, "xxhash"), (1.0, "xxhash"), (0.05, "linear"), (1e-9, "xxhash")):
        with pytest.raises(ValueError):
            split.with_holdout_flag(df, bad, method)


def test_split_of_round_ids_is_random(spark):
    df = spark.range(0, 2500).select((F.col("id") % 50).alias("user_id"),
                                     (F.expr("id div 50") * 10).alias("item_id"))
    per = split.with_holdout_flag(df).groupBy("user_id").agg(
        F.sum(F.col("is_holdout").cast("int")).alias("n")).collect()
    assert sum(r.n == 0 for r in per) < 10 and max(r.n for r in per) < 25


def test_malformed_values_are_rejected_with_a_reason(spark):
    df = spark.createDataFrame([("1", "2", "3.5"), ("x", "2", "3"), ("1", None, "3"),
                                ("1", "y", "3"), ("1", "2", "good"), ("1", "2", None),
                                ("1", "2", "9"), ("1", "2", "NaN"), ("1", "2", "0.1")],
                               "user_id string, item_id string, rating string")
    assert [tuple(r) for r in clean.valid_ratings(df).collect()] == [(1, 2, 3.5)]
    got = sorted(r.reason for r in clean.rating_rejects(df).collect())
    assert got == sorted(["malformed_user", "null_item", "malformed_item", "malformed_rating",
                          "missing_rating", "above_range", "missing_rating", "below_range"])


def test_late_event_does_not_replace_a_newer_row(spark):
    snap = spark.createDataFrame([(1, 7, 4.0, ts(100), 1)], RATING_SCHEMA)
    ev = spark.createDataFrame([(9, 1, 7, 1.0, ts(50)), (10, 2, 7, 2.0, ts(50))], EVENT_SCHEMA)
    got = {(r.user_id, r.rating) for r in merge.upsert(snap, ev).collect()}
    assert got == {(1, 4.0), (2, 2.0)}


@pytest.mark.parametrize("side,other", [("user", "item_id"), ("item", "user_id")])
def test_interaction_lists_are_bounded_whoever_is_hot(spark, side, other):
    """One user with most rows, spread over partitions; every array at most as long as asked."""
    rows = [(1, i, float(1 + i % 5)) for i in range(500)]
    rows += [(u, u * 3 % 40, 2.0) for u in range(2, 90)] + [(None, 5, 1.0), (3, None, 4.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double").repartition(7)
    got = profile.interaction_lists(df, side, 16).collect()
    me = f"{side}_id"
    lists = {}
    for r in sorted(got, key=lambda r: (repr(r[me]), r.chunk)):
        assert len(r.ratings) == r.n <= 16
        assert r.chunk == len(lists.setdefault(r[me], [])) // 16
        lists[r[me]] += [tuple(x) for x in r.ratings]
    want = {}
    for u, i, x in rows:
        a, b = (u, i) if side == "user" else (i, u)
        want.setdefault(a, []).append((b, x))
    assert {k: sorted(v, key=lambda t: (t[0] is not None, t)) for k, v in want.items()} == lists
    assert profile.interaction_lists(df.limit(0), side).count() == 0


def test_readers_of_the_pointer_never_see_a_gap(spark, tmp_path):
    from rankfold.model import read_current_pointer, write_current_pointer
    root = str(tmp_path)
    assert read_current_pointer(spark, root) is None
    write_current_pointer(spark, root, "v0")
    seen, done = [], threading.Event()

    def look():
        while not done.is_set():
            seen.append(read_current_pointer(spark, root))
    reader = threading.Thread(target=look)
    reader.start()
    for n in range(40):
        write_current_pointer(spark, root, f"v{n}")
    done.set()
    reader.join()
    assert read_current_pointer(spark, root) == "v39"
    assert len(seen) > 20 and all(v and v.startswith("v") for v in seen)
    write_current_pointer(spark, root, "a/b=c d")
    assert read_current_pointer(spark, root) == "a/b=c d"
    kept = [f for f in (tmp_path / "current").iterdir() if not f.name.startswith(".")]
    assert len(kept) <= 12
