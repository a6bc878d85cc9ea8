"""Validation of incoming ratings (null ids, missing, malformed or out-of-range values)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold import config

TYPES = {"user_id": "long", "item_id": "long", "rating": "double"}


def _typed(df: DataFrame) -> DataFrame:
    """Ids as long and rating as double; a malformed value becomes null, not an error.

    Columns that have their type already are left as they are, so that a filter on
    them can reach the scan.
    """
    have = dict(df.dtypes)
    cols = [F.col(c) if have[c] in (t, "bigint" if t == "long" else t)
            else F.col(c).try_cast(t).alias(c) for c, t in TYPES.items()]
    return df.select(*cols, *[c for c in df.columns if c not in TYPES])


def is_valid() -> Column:
    """Plain comparisons: sources can evaluate them (NaN is above every range)."""
    r = F.col("rating")
    return (F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
            & (r >= config.RATING_MIN) & (r <= config.RATING_MAX))


def valid_ratings(df: DataFrame) -> DataFrame:
    """Rows with both ids and a rating in [0.5, 5.0]."""
    return _typed(df).filter(is_valid())


def rating_rejects(df: DataFrame) -> DataFrame:
    """Rows that ``valid_ratings`` drops, with the reason.

    A value that is there but cannot be read as its type is ``malformed_...``.
    """
    raw = {c: F.col(f"_raw_{c}") for c in TYPES}
    t = _typed(df.select("*", *[F.col(c).alias(f"_raw_{c}") for c in TYPES]))
    r = F.col("rating")

    def broken(c):
        return F.col(c).isNull() & raw[c].isNotNull()
    reason = (F.when(broken("user_id"), F.lit("malformed_user"))
              .when(F.col("user_id").isNull(), F.lit("null_user"))
              .when(broken("item_id"), F.lit("malformed_item"))
              .when(F.col("item_id").isNull(), F.lit("null_item"))
              .when(broken("rating"), F.lit("malformed_rating"))
              .when(r.isNull() | F.isnan(r), F.lit("missing_rating"))
              .when(r < config.RATING_MIN, F.lit("below_range"))
              .when(r > config.RATING_MAX, F.lit("above_range")))
    return (t.withColumn("reason", reason).filter(F.col("reason").isNotNull())
            .drop(*[f"_raw_{c}" for c in TYPES]))
