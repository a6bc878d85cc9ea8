"""Stand-in inputs built from the read-only test tables.

These functions only re-shape test tables into the schemas the library
expects; they do none of the library's work (no validation, merging,
de-duplication, aggregation or scoring happens here).

Mapping (fixed by the fixture definition of this repository):
  rating rows     lineitem joined to orders: user = o_custkey,
                  item = l_partkey, rating = ceil(l_quantity / 5) / 2,
                  ts = l_shipdate, seq = l_orderkey * 100 + l_linenumber
  base / feedback ts before the year 2000 / from 2000 on
  catalogue       part: item = p_partkey, title = p_name,
                  genres = p_type || '|' || p_brand
  users           customer: user = c_custkey
  rating events   events: item = JSON field k of props,
                  rating = ceil(value / 20) / 2 (not clipped: the library
                  rejects values outside [0.5, 5.0]), seq = event_id
  item vectors    embeddings: item = vec_id, vector = embedding as doubles
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
                    (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq")))


def base_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_ratings(spark, sf_dir).filter(F.year("ts") < 2000)


def feedback_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_ratings(spark, sf_dir).filter(F.year("ts") >= 2000)


def tagged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rating rows in one scan, tagged ``base`` (priority 0) or
    ``feedback`` (priority 1) by the same year rule."""
    fb = F.year("ts") >= 2000
    return raw_ratings(spark, sf_dir).select(
        "*", F.when(fb, F.lit("feedback")).otherwise(F.lit("base")).alias("source"),
        F.when(fb, F.lit(1)).otherwise(F.lit(0)).alias("priority"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"),
                    F.col("p_name").alias("title"),
                    F.concat_ws("|", "p_type", "p_brand").alias("genres"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def event_columns(df: DataFrame) -> DataFrame:
    """Project raw event rows (batch or stream) to rating-event rows."""
    return df.select(
        F.col("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        (F.ceil(F.col("value") / 20).cast("double") / 2).alias("rating"),
        F.col("ts").cast("timestamp_ntz").alias("ts"))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table(spark, sf_dir, "events"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("factors"))
