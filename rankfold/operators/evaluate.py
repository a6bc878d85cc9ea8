"""Holdout evaluation (distributed: nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.functions.vectors import clip_rating, dot


def _joined(holdout: DataFrame, model) -> DataFrame:
    uf = model.user_factors.select("user_id", F.col("bias").alias("_bu"),
                                   F.col("factors").alias("_p"))
    itf = model.item_factors.select("item_id", F.col("bias").alias("_bi"),
                                    F.col("factors").alias("_q"))
    return holdout.select("user_id", "item_id", F.col("rating").alias("actual")).join(
        uf, "user_id", "left").join(itf, "item_id", "left")


def _pred():
    return clip_rating(F.lit(0.0) + F.col("_mu") + F.col("_bu") + F.col("_bi")
                       + dot("_p", "_q"))


def prediction_errors(holdout: DataFrame, model) -> DataFrame:
    """Per holdout pair known on both sides: actual, clipped prediction, |error|."""
    j = _joined(holdout, model).filter(F.col("_p").isNotNull() & F.col("_q").isNotNull())
    j = j.withColumn("_mu", F.lit(model.mu)).withColumn("predicted", _pred())
    return j.select("user_id", "item_id", "actual", "predicted",
                    F.abs(F.col("actual") - F.col("predicted")).alias("error"))


def eval_summary(holdout: DataFrame, model) -> DataFrame:
    """One row: evaluated and skipped pair counts, RMSE and MAE (one pass)."""
    j = _joined(holdout, model).withColumn("_mu", F.lit(model.mu))
    known = F.col("_p").isNotNull() & F.col("_q").isNotNull()
    err = F.when(known, F.col("actual") - _pred())
    return j.agg(F.count(err).alias("n_eval"),
                 F.count(F.when(~known, 1)).alias("n_skipped"),
                 F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.avg(F.abs(err)).alias("mae"))


def bias_only_summary(holdout: DataFrame, model) -> DataFrame:
    """Same metrics for ``mu + b_u + b_i`` (the baseline the factors must beat)."""
    j = _joined(holdout, model)
    known = F.col("_p").isNotNull() & F.col("_q").isNotNull()
    err = F.when(known, F.col("actual") - clip_rating(
        F.lit(model.mu) + F.col("_bu") + F.col("_bi")))
    return j.agg(F.count(err).alias("n_eval"), F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.avg(F.abs(err)).alias("mae"))
