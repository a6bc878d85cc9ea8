"""Last-write-wins merge of rating sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold import config
from rankfold.operators.clean import valid_ratings

ORDER = ("priority", "ts", "seq", "rating")


def keep_last(df: DataFrame, keys=("user_id", "item_id"), order=ORDER) -> DataFrame:
    """One row per key: the greatest by ``order`` (a total order on the row).

    Planned as ``row_number() = 1``; Spark inserts a partial
    ``WindowGroupLimit`` before the shuffle, so repeated keys (even one very
    hot pair) are reduced map-side before they are exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_source(df: DataFrame, name: str, priority: int) -> DataFrame:
    return df.select("user_id", "item_id", "rating", "ts", "seq",
                     F.lit(name).alias("source"), F.lit(priority).alias("priority"))


def merge_tagged(tagged: DataFrame) -> DataFrame:
    """Keep-last merge of rows already tagged with ``source`` and ``priority``
    (one scan when all sources live in one table)."""
    return keep_last(valid_ratings(tagged).select(
        "user_id", "item_id", "rating", "ts", "seq", "source", "priority")).drop("priority")


def merge_ratings(base: DataFrame | None, feedback: DataFrame | None,
                  feedback_only: bool = False) -> DataFrame:
    """Union base and feedback ratings and keep the last row per (user, item).

    Feedback wins over base for the same pair whatever the timestamps (the
    source priority is the first ordering key); within a source the later
    ``(ts, seq)`` wins.  Invalid rows are dropped first.  With
    ``feedback_only`` (or no base) only feedback rows are used; duplicates are
    still removed.
    """
    parts = []
    if base is not None and not feedback_only:
        parts.append(with_source(valid_ratings(base), "base", config.PRIORITY_BASE))
    if feedback is not None:
        parts.append(with_source(valid_ratings(feedback), "feedback",
                                 config.PRIORITY_FEEDBACK))
    if not parts:
        raise ValueError("no rating source given")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return keep_last(u).drop("priority")


def stamped(events: DataFrame) -> DataFrame:
    """Events without a time get the current one.  Done once, where events come in, so
    that every later reader sees the same time."""
    return events.withColumn("ts", F.coalesce(
        F.col("ts").cast("timestamp_ntz"), F.current_timestamp().cast("timestamp_ntz")))


def upsert(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """Apply rating events to a ratings snapshot: the latest ``(ts, seq)`` of a pair wins,
    so a late event cannot replace a newer rating."""
    snap = snapshot.select("user_id", "item_id", "rating", "ts", "seq")
    ev = valid_ratings(stamped(events)).select(
        "user_id", "item_id", "rating", "ts", F.col("event_id").alias("seq"))
    return keep_last(snap.unionByName(ev), order=("ts", "seq", "rating"))
