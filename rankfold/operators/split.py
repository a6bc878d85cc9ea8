"""Deterministic train / holdout split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold import config
from rankfold.functions.vectors import split_bucket

XXHASH_BUCKETS = 1_000_000
LINEAR_BUCKETS = 10


def with_holdout_flag(df: DataFrame, fraction: float = config.HOLDOUT_FRACTION,
                      method: str = "xxhash", seed: int = 42) -> DataFrame:
    """``is_holdout`` by a function of the pair alone.

    The default mixes both ids and the seed, in millionths.  ``linear`` is the form
    that any SQL engine can repeat; it only knows tenths.  A fraction that its
    buckets cannot give, or that leaves a side empty, is an error.
    """
    buckets = LINEAR_BUCKETS if method == "linear" else XXHASH_BUCKETS
    cut = round(fraction * buckets)
    if not 0 < cut < buckets or abs(cut - fraction * buckets) > 1e-6:
        raise ValueError(f"fraction {fraction} is not a split in {buckets} parts")
    return df.withColumn(
        "is_holdout", split_bucket("user_id", "item_id", method, buckets, seed) < cut)


def train_holdout(df: DataFrame, fraction: float = config.HOLDOUT_FRACTION,
                  method: str = "xxhash", seed: int = 42):
    f = with_holdout_flag(df, fraction, method, seed)
    return (f.filter(~F.col("is_holdout")).drop("is_holdout"),
            f.filter(F.col("is_holdout")).drop("is_holdout"))
