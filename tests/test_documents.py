"""The feedback store of schemaless documents."""

import datetime as dt

from conftest import RATING_SCHEMA, ts
from rankfold.operators import clean, merge
from rankfold.sources.documents import read_documents, write_documents


def _ratings(spark):
    rows = [(u, i, float(1 + (u + i) % 9) / 2, ts(u, i) + dt.timedelta(microseconds=250000 * i),
             u * 100 + i) for u in range(12) for i in range(15)]
    return spark.createDataFrame(rows, RATING_SCHEMA)


def test_documents_come_back_as_they_were(spark, tmp_path):
    ratings = _ratings(spark)
    path = write_documents(ratings, str(tmp_path / "d"), 8)
    back = read_documents(spark, path)
    assert back.dtypes == ratings.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ratings.collect()))


def test_lookup_of_a_user_reads_one_folder(spark, tmp_path):
    ratings = _ratings(spark)
    path = write_documents(ratings, str(tmp_path / "d"), 8)
    own = read_documents(spark, path, user=7, buckets=8)
    want = ratings.filter("user_id = 7")
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, want.collect()))
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    read = own.selectExpr("input_file_name() AS f").distinct().collect()
    assert len({r.f.rsplit("/", 2)[1] for r in read}) == 1
    assert read_documents(spark, path, user=99, buckets=8).count() == 0


def test_documents_without_a_schema(spark, tmp_path):
    folder = tmp_path / "d" / "bucket=0"
    folder.mkdir(parents=True)
    (folder / "part.txt").write_text("\n".join([
        '{"userId": 1, "movieId": 2, "rating": 4, "timestamp": 1600000000.5}',
        '{"userId": "1", "movieId": 3, "rating": "3.5", "tags": ["x", {"y": 1}]}',
        '{"movieId": 4, "rating": 3}',
        '{"userId": 1, "movieId": 5, "rating": {"stars": 3}}',
        '{"userId": 1, "movieId": 6, "rating": null, "userId2": 1}',
        '{"userId": 1, "movieId": 2, "rating": 2.5, "timestamp": 1600000001}',
        '{"userId": 1, "movieId": 7, "rat',
        '[1, 2]',
    ]) + "\n")
    rows = read_documents(spark, str(tmp_path / "d"))
    assert rows.count() == 8
    good = {(r.user_id, r.item_id, r.rating, r.ts) for r in clean.valid_ratings(rows).collect()}
    assert good == {(1, 2, 4.0, dt.datetime(2020, 9, 13, 12, 26, 40, 500000)), (1, 3, 3.5, None),
                    (1, 2, 2.5, dt.datetime(2020, 9, 13, 12, 26, 41))}
    last = merge.merge_ratings(None, rows, feedback_only=True)
    assert {(r.item_id, r.rating) for r in last.collect()} == {(2, 2.5), (3, 3.5)}
    assert clean.rating_rejects(rows).count() == 5
