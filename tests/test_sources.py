"""CSV readers in the reference's file layout."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import EVENT_SCHEMA, RATING_SCHEMA, ts
from rankfold.operators import catalogue, clean, merge
from rankfold.sources import read_movies, read_ratings, store


def test_reference_csv_layout(spark):
    d = tempfile.mkdtemp(prefix="rf-csv-")
    with open(os.path.join(d, "ratings.csv"), "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,31,2.5,1260759144\n1,1029,3.0,1260759179\n"
                "2,31,,1260759182\n,40,4.0,1260759185\n")
    with open(os.path.join(d, "movies.csv"), "w") as f:
        f.write('movieId,title,genres\n31,"Dangerous Minds (1995)",Drama\n'
                '1029,"Dumbo (1941)",Animation|Children|Drama|Musical\n'
                '40,"Cry, the Beloved Country (1995)",Drama\n')
    r = read_ratings(spark, os.path.join(d, "ratings.csv"))
    assert r.schema.simpleString() == ("struct<user_id:string,item_id:string,rating:string,"
                                       "ts:timestamp_ntz,seq:bigint>")
    rows = sorted(r.collect(), key=lambda x: (x.user_id is None, x.user_id or "", int(x.item_id)))
    assert rows[0].ts == dt.datetime(2009, 12, 14, 2, 52, 24)
    m = read_movies(spark, os.path.join(d, "movies.csv"))
    merged = merge.merge_ratings(r, None)  # null rating and null user dropped
    assert merged.count() == 2
    cat = {x.item_id: x for x in catalogue.catalogue(m, merged).collect()}
    assert cat[40].title == "Cry, the Beloved Country (1995)"
    assert cat[40].rating_count == 0 and cat[40].avg_rating == 0.0
    assert cat[1029].genres == ["Animation", "Children", "Drama", "Musical"]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("extra,movieId,userId,rating,timestamp,seq\nz,31,1,2.5,1260759144,4\n"
                 "z,oops,2,3,1260759144,5\n")
    r = read_ratings(spark, str(p))
    assert [(x.user_id, x.item_id, x.rating, x.seq) for x in clean.valid_ratings(r).collect()] == [
        (1, 31, 2.5, 4)]
    assert [x.reason for x in clean.rating_rejects(r).collect()] == ["malformed_item"]
    (tmp_path / "bad.csv").write_text("userId,rating\n1,2\n")
    with pytest.raises(ValueError, match="movieId"):
        read_ratings(spark, str(tmp_path / "bad.csv"))


def _files(root):
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def test_upsert_replaces_only_the_partitions_it_touches(spark, tmp_path):
    rows = [(u, i, float(1 + (u + i) % 5), ts(0), u * 100 + i) for u in range(8) for i in range(60)]
    ratings = spark.createDataFrame(rows, RATING_SCHEMA)
    path = store.create_store(ratings, str(tmp_path / "s"), 16)
    before = _files(tmp_path / "s")
    events = spark.createDataFrame(
        [(1, 3, 7, 4.5, ts(1)), (2, 99, 7, 0.5, ts(1)), (3, 3, 8, 2.0, ts(-1)),
         (4, 3, 200, 3.0, ts(1)), (5, 1, 9, 9.0, ts(1))], EVENT_SCHEMA)
    touched = store.upsert_store(events, path, 16)
    want = merge.upsert(ratings, events)
    stats = {r.item_id: (r.avg_rating, r.rating_count) for r in catalogue.movie_stats(want).collect()}
    assert {r.item_id: (r.avg_rating, r.rating_count) for r in touched.collect()} == {
        i: stats[i] for i in (7, 8, 200)}
    assert sorted(map(tuple, store.stored_ratings(spark, path).collect())) == sorted(
        map(tuple, want.select("user_id", "item_id", "rating", "ts", "seq").collect()))
    assert {r.item_id: (r.avg_rating, r.rating_count)
            for r in store.stored_stats(spark, path).collect()} == stats
    after = _files(tmp_path / "s")
    same = {f for f in before if after.get(f) == before[f]}
    gone = {f.split("/")[1] for f in before if f not in same}
    new = {f.split("/")[1] for f in after if f not in same}
    assert 1 <= len(gone) <= 3 and gone <= new and len(new) <= 3  # of 16
    # nothing to do leaves every file as it is
    assert store.upsert_store(events.limit(0), path, 16).count() == 0
    assert _files(tmp_path / "s") == after


def test_upsert_reads_only_the_partitions_it_touches(spark, tmp_path):
    rows = [(u, i, 3.0, ts(0), u * 100 + i) for u in range(3) for i in range(40)]
    path = store.create_store(spark.createDataFrame(rows, RATING_SCHEMA), str(tmp_path / "s"), 8)
    own = store._read(spark, path, "ratings", store.RATING).filter(F.col("bucket").isin([1, 2]))
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan[plan.index("PartitionFilters"):]
    assert len(own.select("bucket").distinct().collect()) == 2


def test_collections_are_replaced_all_at_once(spark, tmp_path):
    root = str(tmp_path / "c")
    with pytest.raises(FileNotFoundError):
        store.collection(spark, root, "movies")
    a = {"movies": spark.range(3), "users": spark.range(5)}
    store.replace_collections(a, root)
    old = store.collection(spark, root, "users")
    store.replace_collections({"movies": spark.range(7), "users": spark.range(2)}, root)
    assert store.collection(spark, root, "movies").count() == 7
    assert store.collection(spark, root, "users").count() == 2
    assert old.count() == 5  # who reads the version before still can
