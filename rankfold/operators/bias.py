"""Global mean, shrunk user and item biases, residual targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold import config


def global_mean(train: DataFrame) -> float:
    """Mean training rating; raises ``ValueError`` on empty input."""
    row = train.agg(F.avg("rating").alias("mu"), F.count(F.lit(1)).alias("n")).first()
    if row is None or row["n"] == 0:
        raise ValueError("empty training ratings")
    return float(row["mu"])


def user_bias(train: DataFrame, mu, shrink: float = config.BIAS_REG) -> DataFrame:
    """``b_u = sum(r - mu) / (n_u + shrink)`` (hash aggregate, partial + final)."""
    return (train.groupBy("user_id")
            .agg(F.sum(F.col("rating") - F.lit(mu)).alias("_s"), F.count(F.lit(1)).alias("n"))
            .select("user_id", (F.col("_s") / (F.col("n") + shrink)).alias("bias"), "n"))


def item_bias(train: DataFrame, mu, ub: DataFrame,
              shrink: float = config.BIAS_REG) -> DataFrame:
    """``b_i = sum(r - mu - b_u) / (n_i + shrink)``; a user without bias counts 0."""
    j = train.join(ub.select("user_id", F.col("bias").alias("_bu")), "user_id", "left")
    return (j.groupBy("item_id")
            .agg(F.sum(F.col("rating") - F.lit(mu) - F.coalesce("_bu", F.lit(0.0))).alias("_s"),
                 F.count(F.lit(1)).alias("n"))
            .select("item_id", (F.col("_s") / (F.col("n") + shrink)).alias("bias"), "n"))


def residuals(train: DataFrame, mu, ub: DataFrame, ib: DataFrame) -> DataFrame:
    """Training rows with the target ``y = r - mu - b_u - b_i`` of the factor model,
    plus the rating counts of both sides (used to salt hot entities)."""
    return (train.select("user_id", "item_id", "rating")
            .join(ub.select("user_id", F.col("bias").alias("b_u"), F.col("n").alias("n_u")),
                  "user_id")
            .join(ib.select("item_id", F.col("bias").alias("b_i"), F.col("n").alias("n_i")),
                  "item_id")
            .withColumn("y", F.col("rating") - F.lit(mu) - F.col("b_u") - F.col("b_i")))
