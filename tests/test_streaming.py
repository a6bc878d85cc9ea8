"""The live store equals a batch upsert of the same events."""

import os
import random
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import EVENT_SCHEMA, RATING_SCHEMA, ts
from rankfold.operators import catalogue, merge
from rankfold.session import scratch_path
from rankfold.streaming import item_stats


def _write(folder, name, rows):
    t = pa.table({"event_id": [r[0] for r in rows], "user_id": [r[1] for r in rows],
                  "item_id": [r[2] for r in rows], "rating": [r[3] for r in rows],
                  "ts": pa.array([r[4] for r in rows], pa.timestamp("us"))})
    pq.write_table(t, os.path.join(folder, name))


def _stream(spark, src):
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", "1")
            .parquet(src))


def _store(spark, batches, base=None):
    src = tempfile.mkdtemp(prefix="rf-src-")
    for n, rows in enumerate(batches):
        _write(src, f"part-{n:03d}.parquet", rows)
    stored = None
    if base:
        path = scratch_path(spark, "t", "base")
        spark.createDataFrame(base, RATING_SCHEMA).write.parquet(path)
        stored = spark.readStream.schema(RATING_SCHEMA).parquet(path)
    checkpoint = scratch_path(spark, "t", "ck")
    item_stats.run(_stream(spark, src), checkpoint, stored)
    return checkpoint


def _run(spark, batches, base=None):
    return _stats(spark, _store(spark, batches, base))


def _stats(spark, checkpoint):
    return {r.item_id: (round(r.avg_rating, 9), r.rating_count)
            for r in item_stats.live_stats(spark, checkpoint).collect()}


def _ratings(spark, checkpoint):
    return sorted(tuple(r) for r in item_stats.live_ratings(spark, checkpoint).select(
        "user_id", "item_id", "rating").collect())


def test_rerating_changes_average_not_count(spark):
    got = _run(spark, [[(1, 1, 7, 4.0, ts(0))], [(2, 2, 7, 2.0, ts(1))],
                       [(3, 1, 7, 5.0, ts(2))]])
    assert got == {7: (3.5, 2)}


def test_late_event_does_not_overwrite(spark):
    got = _run(spark, [[(2, 1, 7, 5.0, ts(5))], [(1, 1, 7, 1.0, ts(1))]])
    assert got == {7: (5.0, 1)}


def test_invalid_events_dropped(spark):
    got = _run(spark, [[(1, 1, 7, 9.0, ts(0)), (2, 2, 7, 0.0, ts(0)), (3, 3, 7, 3.0, ts(0))]])
    assert got == {7: (3.0, 1)}


@pytest.mark.parametrize("seed", [0, 1])
def test_stream_equals_batch_under_shuffled_splits(spark, seed):
    rnd = random.Random(seed)
    events = [(e, rnd.randrange(6), rnd.randrange(4), rnd.choice([1.0, 2.5, 4.0, 5.0, 7.0]),
               ts(0, rnd.randrange(50))) for e in range(60)]
    shuffled = events[:]
    rnd.shuffle(shuffled)
    cuts = sorted(rnd.sample(range(1, 60), 4))
    batches = [shuffled[a:b] for a, b in zip([0] + cuts, cuts + [60])]
    got = _run(spark, batches)
    ev = spark.createDataFrame(events, EVENT_SCHEMA)
    snap = spark.createDataFrame([], "user_id long, item_id long, rating double, "
                                     "ts timestamp_ntz, seq long")
    latest = merge.upsert(snap, ev)
    want = {r.item_id: (round(r.avg_rating, 9), r.rating_count)
            for r in catalogue.movie_stats(latest).collect()}
    assert got == want


def test_batch_upsert_touched_items(spark):
    snap = spark.createDataFrame([(1, 7, 4.0, ts(0), 1), (2, 7, 2.0, ts(0), 2),
                                  (3, 8, 1.0, ts(0), 3)],
                                 "user_id long, item_id long, rating double, ts timestamp_ntz, "
                                 "seq long")
    ev = spark.createDataFrame([(10, 1, 7, 5.0, ts(1)), (11, 4, 99, 3.0, ts(1))], EVENT_SCHEMA)
    cat = spark.createDataFrame([(7, "seven"), (8, "eight")], "item_id long, title string")
    new, touched = catalogue.rating_upsert(snap, ev, cat)
    assert {(r.item_id, r.avg_rating, r.rating_count) for r in touched.collect()} == {(7, 3.5, 2)}
    assert new.filter("item_id = 99").count() == 1  # kept although not in the catalogue


def _mixed(seed):
    rnd = random.Random(seed)
    events = [(e, rnd.randrange(5), rnd.randrange(4), rnd.choice([1.0, 3.0, 4.5, 9.0]),
               ts(1, rnd.randrange(40))) for e in range(40)]
    base = [(0, 0, 2.0, ts(0), 1), (9, 9, 3.0, ts(0), 2), (1, 1, 5.0, ts(9), 3)]
    return events, base


def test_state_equals_batch_upsert(spark):
    events, base = _mixed(7)
    checkpoint = _store(spark, [events[n * 10:(n + 1) * 10] for n in range(4)], base)
    want = merge.upsert(spark.createDataFrame(base, RATING_SCHEMA),
                        spark.createDataFrame(events, EVENT_SCHEMA))
    assert _ratings(spark, checkpoint) == sorted(
        tuple(r) for r in want.select("user_id", "item_id", "rating").collect())
    assert _stats(spark, checkpoint) == {
        r.item_id: (round(r.avg_rating, 9), r.rating_count)
        for r in catalogue.movie_stats(want).collect()}


def test_late_and_replayed_events_change_nothing(spark):
    events, base = _mixed(8)
    once = _store(spark, [events[:20], events[20:]], base)
    again = _store(spark, [events[:20], events[20:], events, events[::-1]], base)
    assert _stats(spark, again) == _stats(spark, once)
    assert _ratings(spark, again) == _ratings(spark, once)


def test_restart_from_the_checkpoint_goes_on_where_it_stopped(spark):
    events, _ = _mixed(9)
    src, checkpoint = tempfile.mkdtemp(prefix="rf-src-"), scratch_path(spark, "t", "ck")
    _write(src, "part-000.parquet", events[:15])
    item_stats.run(_stream(spark, src), checkpoint)
    first = _ratings(spark, checkpoint)
    q = item_stats.run(_stream(spark, src), checkpoint)  # nothing new
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert _ratings(spark, checkpoint) == first
    _write(src, "part-001.parquet", events[15:])
    q = item_stats.run(_stream(spark, src), checkpoint)
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(events) - 15
    whole = _store(spark, [events])
    assert _ratings(spark, checkpoint) == _ratings(spark, whole) != first
    assert _stats(spark, checkpoint) == _stats(spark, whole)


def test_pairs_of_a_bucket_take_one_state_call(spark, monkeypatch):
    """The state has a key per bucket, not one per pair, and nothing of a pair is lost."""
    monkeypatch.setattr(item_stats.config, "LIVE_BUCKETS", 3)
    rnd = random.Random(5)
    events = [(e, rnd.randrange(12), rnd.randrange(9), rnd.choice([0.5, 2.0, 3.5]),
               ts(2, rnd.randrange(30))) for e in range(150)]
    base = [(u, i, 4.0, ts(2, 10), 2 ** 60 + u) for u in range(15) for i in range(5)]
    base[7] = (*base[7][:3], None, None)  # before all that has a time
    checkpoint = _store(spark, [events[:70], events[70:]], base)
    want = merge.upsert(spark.createDataFrame(base, RATING_SCHEMA),
                        spark.createDataFrame(events, EVENT_SCHEMA))
    columns = ["user_id", "item_id", "rating", "ts", "seq"]
    got = item_stats.live_ratings(spark, checkpoint)
    assert dict(got.dtypes)["ts"] == "timestamp_ntz"
    assert sorted(map(repr, got.select(columns).collect())) == sorted(
        map(repr, want.select(columns).collect()))
    assert _stats(spark, checkpoint) == {
        r.item_id: (round(r.avg_rating, 9), r.rating_count)
        for r in catalogue.movie_stats(want).collect()}
    assert item_stats._state(spark, checkpoint, item_stats.PAIRS,
                             stateVarName="latest").count() <= 3


def test_deltas_take_the_old_value_out_and_the_new_one_in(spark):
    src, checkpoint = tempfile.mkdtemp(prefix="rf-src-"), scratch_path(spark, "t", "ck")
    for n, rows in enumerate([[(1, 1, 7, 4.0, ts(0)), (2, 2, 8, 2.0, ts(0))],
                              [(3, 1, 7, 1.5, ts(2)), (4, 2, 8, 5.0, ts(-1))]]):
        _write(src, f"part-{n:03d}.parquet", rows)
    out = scratch_path(spark, "t", "deltas")
    w = item_stats.item_deltas(item_stats.rating_stream(_stream(spark, src))).writeStream
    w.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, n: df.write.parquet(f"{out}/n={n}")).trigger(availableNow=True).start(
        ).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(7, -2.5, 0, 1), (7, 4.0, 1, 0), (8, 2.0, 1, 0)]


def test_changed_sums_reach_a_sink(spark):
    src, out = tempfile.mkdtemp(prefix="rf-src-"), []
    _write(src, "part-000.parquet", [(1, 1, 7, 4.0, ts(0)), (2, 2, 7, 2.0, ts(0))])
    item_stats.run(_stream(spark, src), scratch_path(spark, "t", "ck"), sink=lambda w: (
        w.foreachBatch(lambda df, n: out.extend(tuple(r) for r in df.collect()))))
    assert out == [(7, 6.0, 2)]


def test_events_of_a_batch_without_a_time_take_the_batchs(spark):
    checkpoint = _store(spark, [[(1, 1, 7, 4.0, None)]], [(1, 7, 5.0, ts(0), 1)])
    row = item_stats.live_ratings(spark, checkpoint).first()
    assert row.rating == 4.0 and row.ts > ts(0)


def test_live_popularity(spark):
    root = _store(spark, [[(1, 1, 7, 5.0, ts(5)), (2, 2, 8, 4.0, ts(5))]], [(3, 8, 5.0, ts(0), 1)])
    movies = spark.createDataFrame([(7, "seven"), (8, "eight")], "item_id long, title string")
    top = item_stats.live_popular(spark, root, movies, 2).orderBy("rank").collect()
    assert [(r.item_id, r.avg_rating, r.rating_count) for r in top] == [(7, 5.0, 1), (8, 4.5, 2)]


def test_event_without_time_is_stamped(spark):
    snap = spark.createDataFrame([(1, 7, 4.0, ts(0), 1)],
                                 "user_id long, item_id long, rating double, ts timestamp_ntz, "
                                 "seq long")
    ev = spark.createDataFrame([(10, 1, 7, 2.0, None)], EVENT_SCHEMA)
    r = merge.upsert(snap, ev).collect()
    assert len(r) == 1 and r[0].rating == 2.0 and r[0].ts is not None
