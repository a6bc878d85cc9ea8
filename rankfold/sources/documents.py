"""Feedback store of schemaless documents: one JSON object a line, read as VARIANT.

A document holds what an application stored: ``userId``, ``movieId``, ``rating``, a
``timestamp`` in seconds since 1970 with a fraction, and whatever else.  No field is sure to
be there or of one type.  Documents lie in folders by a hash of the user, so the ratings of
one user are read from one folder: the filter on ``bucket`` prunes the scan, and nothing is
parsed for other folders.

A field that is missing, or cannot be read as its type, is null; so is every field of a line
that is no JSON object.  ``clean`` drops or reports such rows like those of any other source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import config

FIELDS = {"user_id": ("userId", "long"), "item_id": ("movieId", "long"),
          "rating": ("rating", "double"), "ts": ("timestamp", "double"), "seq": ("seq", "long")}


def _bucket(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user.cast("long")), F.lit(buckets)).cast("int")


def write_documents(ratings: DataFrame, path: str,
                    buckets: int = config.STORE_BUCKETS) -> str:
    """Append ratings (``user_id, item_id, rating, ts, seq``) as documents; returns ``path``.

    A very active user's documents are spread over several files of their folder: rows stay
    in the tasks that hold them.
    """
    own = {"ts": F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)}
    doc = F.struct(*[own.get(c, F.col(c)).alias(field) for c, (field, _) in FIELDS.items()])
    (ratings.select(F.to_json(doc).alias("value"), _bucket(F.col("user_id"), buckets)
                    .alias("bucket"))
     .sortWithinPartitions("bucket").write.mode("append").partitionBy("bucket").text(path))
    return path


def read_documents(spark: SparkSession, path: str, user: int | None = None,
                   buckets: int = config.STORE_BUCKETS) -> DataFrame:
    """Ratings of the store as ``user_id, item_id, rating, ts, seq``; only those of ``user``
    if one is given.  ``buckets`` is the number the store was written with."""
    docs = spark.read.schema("value string, bucket int").text(path)
    if user is not None:
        docs = docs.filter(F.col("bucket") == _bucket(F.lit(user), buckets))
    got = docs.select(F.try_parse_json("value").alias("doc")).select(*[F.try_variant_get("doc", f"$.{field}", kind).alias(c)
                        for c, (field, kind) in FIELDS.items()])
    if user is not None:
        got = got.filter(F.col("user_id") == user)
    return got.withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
