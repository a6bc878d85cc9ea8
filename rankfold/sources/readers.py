"""Readers for rating, catalogue and rating-event data.

All readers return DataFrames in the library's column names; the column mapping
lets the same code read ``userId, movieId, rating, timestamp`` CSV files or any
table of another naming.  No pass over the data infers types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATING_COLUMNS = {"user_id": "userId", "item_id": "movieId", "rating": "rating",
                  "ts": "timestamp"}


def _ts_expr(col, kind: str):
    if kind == "epoch_seconds":
        return F.timestamp_seconds(col).cast("timestamp_ntz")
    return col.cast("timestamp_ntz")


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv",
                 columns: dict[str, str] | None = None,
                 ts_kind: str = "epoch_seconds", options: dict | None = None
                 ) -> DataFrame:
    """Scan a rating table and project it to ``user_id, item_id, rating, ts, seq``.

    Columns are chosen by name.  Ids and ratings keep the type they are read as (text
    in CSV): ``clean`` types them and reports what cannot be read.

    ``columns`` maps library names to source names; a missing ``ts`` source
    column yields null timestamps.  ``seq`` is taken from a ``seq`` source
    column when present, else null (arrival order unknown).
    """
    cols = dict(RATING_COLUMNS if fmt == "csv" else
                {"user_id": "user_id", "item_id": "item_id", "rating": "rating",
                 "ts": "ts"})
    cols.update(columns or {})
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # no schema: columns are strings named by the header, in any order and number
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    have = set(df.columns)
    missing = {cols[c] for c in ("user_id", "item_id", "rating")} - have
    if missing:
        raise ValueError(f"{path} has no column {sorted(missing)}")
    ts = (_ts_expr(F.col(cols["ts"]).try_cast("double") if fmt == "csv" and ts_kind ==
                   "epoch_seconds" else F.col(cols["ts"]), ts_kind)
          if cols.get("ts") in have else F.lit(None).cast("timestamp_ntz"))
    seq = F.col("seq").try_cast("long") if "seq" in have else F.lit(None).cast("long")
    return df.select(
        F.col(cols["user_id"]).alias("user_id"), F.col(cols["item_id"]).alias("item_id"),
        F.col(cols["rating"]).alias("rating"), ts.alias("ts"), seq.alias("seq"))


def read_movies(spark: SparkSession, path: str, fmt: str = "csv",
                columns: dict[str, str] | None = None) -> DataFrame:
    """Scan a movie table (``movieId, title, genres`` with ``a|b|c`` genres)."""
    cols = {"item_id": "movieId", "title": "title", "genres": "genres"}
    cols.update(columns or {})
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("quote", '"').option(
            "escape", '"')
    df = reader.load(path)
    return df.select(F.col(cols["item_id"]).try_cast("long").alias("item_id"),
                     F.col(cols["title"]).cast("string").alias("title"),
                     F.col(cols["genres"]).cast("string").alias("genres"))
