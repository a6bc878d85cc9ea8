"""Stored ratings and collections that are replaced, whole or in the parts that change.

``create_store`` writes ratings and item statistics as Parquet partitioned by a hash of
the item.  ``upsert_store`` reads only the partitions that rating events fall into,
applies the events, and overwrites just these (dynamic partition overwrite); files of
other partitions are not touched.  The new rows are written aside first, so a job that
is repeated after a failure starts from whole tables.

``replace_collections`` writes all tables of a new version and then moves one pointer, so
readers see either all the old ones or all the new ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import config
from rankfold.model import read_current_pointer, write_current_pointer
from rankfold.operators.catalogue import movie_stats
from rankfold.operators.clean import valid_ratings
from rankfold.operators.merge import stamped, upsert
from rankfold.session import scratch_path

RATING = "user_id long, item_id long, rating double, ts timestamp_ntz, seq long"
STATS = "item_id long, avg_rating double, rating_count long"


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("item_id").cast("long")), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, table: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{kind}, bucket int").parquet(f"{path}/{table}")


def _write(rows: DataFrame, path: str, table: str) -> None:
    """Overwrite the partitions that ``rows`` fall into, each by few files."""
    (rows.repartition("bucket").sortWithinPartitions("bucket", "item_id").write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket")
     .parquet(f"{path}/{table}"))


def create_store(ratings: DataFrame, path: str, buckets: int = config.STORE_BUCKETS) -> str:
    """Write a store from ratings with one row per pair; returns ``path``."""
    rows = ratings.select("user_id", "item_id", "rating", "ts", "seq").withColumn(
        "bucket", _bucket(buckets))
    _write(rows, path, "ratings")
    spark = ratings.sparkSession
    _write(movie_stats(_read(spark, path, "ratings", RATING)).withColumn(
        "bucket", _bucket(buckets)), path, "stats")
    return path


def stored_ratings(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "ratings", RATING).drop("bucket")


def stored_stats(spark: SparkSession, path: str) -> DataFrame:
    """``item_id, avg_rating, rating_count`` of every rated item."""
    return _read(spark, path, "stats", STATS).drop("bucket")


def upsert_store(events: DataFrame, path: str, buckets: int = config.STORE_BUCKETS) -> DataFrame:
    """Apply rating events to the store; returns the new statistics of the items that got a
    valid event.  ``buckets`` is the number the store was created with."""
    spark = events.sparkSession
    aside = scratch_path(spark, "upsert")
    valid_ratings(stamped(events)).select("event_id", "user_id", "item_id", "rating", "ts").write.parquet(
        f"{aside}/events")
    ev = spark.read.parquet(f"{aside}/events")
    # one number per partition of the store; as literals they prune the scan
    touched = [r[0] for r in ev.select(_bucket(buckets)).distinct().collect()]
    own = _read(spark, path, "ratings", RATING).filter(F.col("bucket").isin(touched))
    upsert(own.drop("bucket"), ev).withColumn("bucket", _bucket(buckets)).write.parquet(
        f"{aside}/ratings")
    rows = spark.read.parquet(f"{aside}/ratings")
    movie_stats(rows).withColumn("bucket", _bucket(buckets)).write.parquet(f"{aside}/stats")
    stats = spark.read.parquet(f"{aside}/stats")
    _write(rows, path, "ratings")
    _write(stats, path, "stats")
    return stats.drop("bucket").join(ev.select("item_id").distinct(), "item_id", "left_semi")


def replace_collections(tables: dict[str, DataFrame], root: str) -> str:
    """Replace all collections below ``root`` at once by the given tables; returns the name of
    the version written."""
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
    write_current_pointer(spark, root, version)
    return version


def collection(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A collection as of the current version."""
    version = read_current_pointer(spark, root)
    if version is None:
        raise FileNotFoundError(f"no collections below {root}")
    return spark.read.parquet(f"{root}/{version}/{name}")
