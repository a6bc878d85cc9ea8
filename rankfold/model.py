"""Model tables and their Parquet persistence.

A model is three tables: ``user_factors(user_id, bias, n, factors)``,
``item_factors(item_id, bias, n, factors)`` and a one-row ``meta`` table
(mu, rank, reg, bias_reg, iterations, solver, trained_at, and the holdout
metrics when known).  Saved models live in a version folder; a ``current``
pointer names the promoted one.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold import config

META_SCHEMA = ("mu double, rank int, reg double, bias_reg double, iterations int, "
               "solver string, trained_at timestamp, rmse double, mae double, "
               "n_train long")


@dataclass
class Model:
    mu: float
    user_factors: DataFrame
    item_factors: DataFrame
    rank: int
    reg: float
    bias_reg: float
    iterations: int
    solver: str
    history: DataFrame | None = None
    rmse: float | None = None
    mae: float | None = None
    n_train: int | None = None
    trained_at: _dt.datetime | None = None

    def meta(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(
            float(self.mu), int(self.rank), float(self.reg), float(self.bias_reg),
            int(self.iterations), self.solver,
            self.trained_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
            self.rmse, self.mae, self.n_train)], META_SCHEMA)


def save_model(model: Model, path: str) -> str:
    """Write the three model tables below ``path`` (overwrite)."""
    spark = model.user_factors.sparkSession
    model.user_factors.write.mode("overwrite").parquet(os.path.join(path, "user_factors"))
    model.item_factors.write.mode("overwrite").parquet(os.path.join(path, "item_factors"))
    model.meta(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "meta"))
    if model.history is not None:
        model.history.coalesce(1).write.mode("overwrite").parquet(
            os.path.join(path, "history"))
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_model(spark: SparkSession, path: str) -> Model:
    meta = spark.read.parquet(os.path.join(path, "meta")).first()
    hist = (spark.read.parquet(os.path.join(path, "history"))
            if _exists(spark, os.path.join(path, "history")) else None)
    return Model(mu=meta["mu"],
                 user_factors=spark.read.parquet(os.path.join(path, "user_factors")),
                 item_factors=spark.read.parquet(os.path.join(path, "item_factors")),
                 rank=meta["rank"], reg=meta["reg"], bias_reg=meta["bias_reg"],
                 iterations=meta["iterations"], solver=meta["solver"], history=hist,
                 rmse=meta["rmse"], mae=meta["mae"], n_train=meta["n_train"],
                 trained_at=meta["trained_at"])


def promote_decision(current: DataFrame | None, candidate: DataFrame,
                     max_rmse_increase: float = 0.0) -> DataFrame:
    """Compare two one-row metric tables (``rmse, mae``); one row with
    ``promote`` true when the candidate is no worse (within the tolerance)."""
    c = candidate.select(F.col("rmse").alias("new_rmse"), F.col("mae").alias("new_mae"))
    if current is None:
        return c.withColumn("old_rmse", F.lit(None).cast("double")).withColumn(
            "old_mae", F.lit(None).cast("double")).withColumn("promote", F.lit(True))
    old = current.select(F.col("rmse").alias("old_rmse"), F.col("mae").alias("old_mae"))
    # both sides are single-row metric tables: the scalar subqueries keep it a plain projection
    return c.select("new_rmse", "new_mae",
                    old.select("old_rmse").scalar().alias("old_rmse"),
                    old.select("old_mae").scalar().alias("old_mae")).withColumn(
        "promote", (F.col("new_rmse") <= F.col("old_rmse") + F.lit(max_rmse_increase))
        & (F.col("new_mae") <= F.col("old_mae") + F.lit(max_rmse_increase)))


def retrain(base: DataFrame | None, feedback: DataFrame | None, out: str,
            feedback_only: bool = False, version: str | None = None, rank: int = config.RANK,
            iterations: int = config.ITERATIONS, reg: float = config.REG,
            method: str = "xxhash", max_rmse_increase: float = 0.0) -> DataFrame:
    """Train a new model version from the rating sources and promote it if it is no worse.

    Merges the sources (only feedback with ``feedback_only``), splits, fits the exact
    solver, evaluates on the holdout, and writes below ``out/<version>`` the model with its
    metrics and, as ``predictions``, the evaluated pairs.  The version named by
    ``out/current``, if any, is evaluated on the same holdout; the pointer moves to the new
    version when neither RMSE nor MAE rises by more than ``max_rmse_increase``.  Everything
    of a version is written before the pointer, so readers never see half of one.

    Returns one row: version, n_train, n_eval, n_skipped, old and new metrics, promote.
    """
    from rankfold.operators import als, evaluate, merge, split

    source = base if base is not None else feedback
    spark = source.sparkSession
    merged = merge.merge_ratings(base, feedback, feedback_only).checkpoint(eager=True)
    train, hold = split.train_holdout(merged, method=method)
    model = als.fit_exact(train, rank, iterations, reg)
    model.n_train = train.count()
    e = evaluate.eval_summary(hold, model).first()
    model.rmse, model.mae = e["rmse"], e["mae"]
    version = version or uuid.uuid4().hex
    path = save_model(model, f"{out}/{version}")
    evaluate.prediction_errors(hold, model).write.mode("overwrite").parquet(
        f"{path}/predictions")
    metrics = "rmse double, mae double"
    new = spark.createDataFrame([(model.rmse, model.mae)], metrics)
    current = read_current_pointer(spark, out)
    old = None
    if current is not None:
        o = evaluate.eval_summary(hold, load_model(spark, f"{out}/{current}")).first()
        old = spark.createDataFrame([(o["rmse"], o["mae"])], metrics)
    decision = promote_decision(old, new, max_rmse_increase).first()
    if decision["promote"]:
        write_current_pointer(spark, out, version)
    return spark.createDataFrame(
        [(version, model.n_train, e["n_eval"], e["n_skipped"], decision["old_rmse"],
          decision["new_rmse"], decision["old_mae"], decision["new_mae"],
          decision["promote"])],
        "version string, n_train long, n_eval long, n_skipped long, old_rmse double, "
        "new_rmse double, old_mae double, new_mae double, promote boolean")


# Pointers that stay after newer ones, for readers that list the folder meanwhile.
POINTERS_KEPT = 10


def _pointers(spark: SparkSession, root: str):
    """File system, folder, and the pointers in it as (number, version, path), oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "current"))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        number, _, version = status.getPath().getName().partition("=")
        if number.isdigit():
            found.append((int(number), unquote(version), status.getPath()))
    return fs, folder, sorted(found, key=lambda p: p[:2])


def write_current_pointer(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one.

    A pointer is an empty file whose name has a number and the version; the largest number
    counts.  It comes into being by one rename, next to the pointers before it, of which the
    last ones stay; so a reader finds the old version or the new one, never neither.
    """
    fs, folder, before = _pointers(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    number = before[-1][0] + 1 if before else 0
    fs.mkdirs(folder)
    aside = path(folder, f".{uuid.uuid4().hex}")
    fs.create(aside, True).close()
    if not fs.rename(aside, path(folder, f"{number:012d}={quote(version, safe='')}")):
        raise OSError(f"the pointer below {root} could not be moved")
    for _, _, old in before[:-POINTERS_KEPT]:
        fs.delete(old, False)


def read_current_pointer(spark: SparkSession, root: str) -> str | None:
    found = _pointers(spark, root)[2]
    return found[-1][1] if found else None


def retrain_due(ratings: DataFrame, trained_at, min_new: int = 1000) -> DataFrame:
    """One row: number of ratings newer than the model and whether that
    reaches ``min_new`` (the retraining trigger)."""
    n = ratings.filter(F.col("ts") > F.lit(trained_at)).agg(F.count(F.lit(1)).alias("n_new"))
    return n.withColumn("retrain", F.col("n_new") >= F.lit(min_new))
