"""Shared text helpers: words, private column names, tables written between steps."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.session import ensure_checkpoint_dir

# A word is a maximal run of characters other than these six.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` does not use (case ignored)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The array of words of a text; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_GAP))


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder, and its reader."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a written table that nothing is going to read again."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept_table(df: DataFrame) -> DataFrame:
    """A small step's result as a written table, so that the next one is planned by its
    real size and starts from files that outlive executors."""
    return written_table(df, "kept")


def release(spark) -> None:
    """Let Spark remove the shuffle files of steps whose results are written.

    It does so when the driver's garbage is collected, which a driver with little to do
    may put off past the end of a job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
