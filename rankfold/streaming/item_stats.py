"""Ratings, item statistics and popularity kept current as rating events arrive.

One Structured Streaming query with two stateful operators, whose state is all there
is: no table, log or pointer besides the query's own checkpoint.

* ``LatestRating`` (``transformWithStateInPandas``, keyed by a bucket of pairs of user and
  item) holds the latest rating of each pair with its ``(ts, seq)`` in the RocksDB state
  store.  An event that is no later changes nothing, which makes late and replayed events
  harmless.  One that is later comes out as an item delta: the new value in, the old one out.
* The deltas are summed per item by a streaming aggregation.

A bucket is a hash of the pair, so a very active user or a very popular item is spread over
all state partitions; deltas are combined before they are exchanged by item.  Each call of
the state from Python is a round trip to the JVM, so a micro-batch reads and writes a bucket
once, however many of its pairs it has; what it does not touch stays as it is.  Stored ratings
enter as the first rows of the same stream, and events without a time take the time of their
micro-batch, which Spark records, so a batch that is run again stamps the same.

Both states are read back through the ``statestore`` data source, always as of the last
committed micro-batch, while the query runs or after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rankfold import config
from rankfold.operators.clean import valid_ratings
from rankfold.operators.merge import stamped
from rankfold.operators.scoring import popular_items
from rankfold.session import ship_package

EVENT = "user_id long, item_id long, rating double, ts timestamp_ntz, seq long"
# the pairs of a bucket, entry by entry; times are microseconds from 1970 on
BUCKET = ("users array<long>, items array<long>, ratings array<double>, times array<long>, "
          "seqs array<long>")
DELTA = "item_id long, rating_sum double, rating_count long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# operators of the query as Spark numbers them, from the sink
ITEMS, PAIRS = 0, 1
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
NOTHING = -2 ** 63  # stands for a missing time or seq, which is before all others


def _ordered(users, items, ratings, times, seqs, stored):
    """Order of the rows by pair and what is later in it, and the last place of each pair."""
    order = np.lexsort((ratings, stored, seqs, times, items, users))
    u, i = users[order], items[order]
    return order, np.flatnonzero(np.append((u[1:] != u[:-1]) | (i[1:] != i[:-1]), True))


class LatestRating(StatefulProcessor):
    """Latest rating of each pair of a bucket; emits what a later one changes of its item."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", BUCKET)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        new = None
        for frame in rows:  # cut to the pairs as they come: a very hot one may fill many
            got = [frame[c].to_numpy() for c in (
                "user_id", "item_id", "rating", "time", "seq")]
            new = got if new is None else [np.concatenate(c) for c in zip(new, got)]
            order, last = _ordered(*new, np.zeros(len(new[0]), bool))
            new = [c[order[last]] for c in new]
        if new is None:
            return
        held = self.latest.get()
        old = [np.array(c, k.dtype) for c, k in zip(held or [[]] * len(new), new)]
        both = [np.concatenate(c) for c in zip(old, new)]
        stored = np.arange(len(both[0])) < len(old[0])
        order, last = _ordered(*both, stored)  # at one time, what is stored stays
        kept = order[last]
        changed = ~stored[kept]
        if not changed.any():
            return
        self.latest.update(tuple(c[kept].tolist() for c in both))
        # a pair has one stored rating at most
        pair = np.repeat(np.arange(len(last)), np.diff(np.append(-1, last)))
        was, before = np.zeros(len(last)), np.zeros(len(last), bool)
        of = pair[stored[order]]
        was[of], before[of] = both[2][order[stored[order]]], True
        yield pd.DataFrame({
            "item_id": both[1][kept][changed], "rating_sum": (both[2][kept] - was)[changed],
            "rating_count": np.where(before, 0, 1)[changed]})

    def close(self) -> None:
        pass


def _use_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs this state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def rating_stream(events: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Valid rating events (``event_id, user_id, item_id, rating, ts``), after the rows of
    ``stored``, a stream of the ratings store."""
    rows = valid_ratings(stamped(events)).withColumn("seq", F.coalesce(
        F.col("event_id").cast("long"), F.lit(0).cast("long")))
    columns = ["user_id", "item_id", "rating", "ts", "seq"]
    rows = rows.select(*columns)
    if stored is None:
        return rows
    return stored.select(*[F.col(c).cast(t).alias(c) for c, t in (
        x.split(" ") for x in EVENT.split(", "))]).unionByName(rows)


def item_deltas(ratings: DataFrame) -> DataFrame:
    """What each later rating of a pair changes in its item's rating sum and count."""
    ship_package(ratings.sparkSession)
    _use_rocksdb(ratings.sparkSession)
    rows = ratings.select(
        F.pmod(F.xxhash64("user_id", "item_id"), F.lit(config.LIVE_BUCKETS)).cast("int")
        .alias("bucket"), "user_id", "item_id", "rating",
        F.coalesce(F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)"), F.lit(NOTHING))
        .alias("time"), F.coalesce("seq", F.lit(NOTHING)).alias("seq"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        LatestRating(), DELTA, "update", "None")


def item_sums(ratings: DataFrame) -> DataFrame:
    """Rating sum and count of the items whose ratings changed (for update mode)."""
    return item_deltas(ratings).groupBy("item_id").agg(
        F.sum("rating_sum").alias("rating_sum"),
        # a pair counts when it is new
        F.count(F.when(F.col("rating_count") == 1, 1)).alias("rating_count"))


def run(events: DataFrame, checkpoint: str, stored: DataFrame | None = None,
        available_now: bool = True, processing_time: str | None = None, sink=None):
    """Start the query over a stream of rating events; with ``available_now`` it processes
    what is there and stops (the call waits for it).  ``sink(writer)`` may choose a sink for
    the item sums that change; without one they are only kept as state.  Returns the query."""
    w = item_sums(rating_stream(events, stored)).writeStream.outputMode("update")
    w = (sink(w) if sink else w.format("noop")).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def _state(spark: SparkSession, checkpoint: str, operator: int, **options) -> DataFrame:
    _use_rocksdb(spark)
    return (spark.read.format("statestore").option("operatorId", operator)
            .options(**options).load(checkpoint))


def live_ratings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The current rating of every pair, from the state."""
    pairs = _state(spark, checkpoint, PAIRS, stateVarName="latest").select(F.inline(F.arrays_zip(
        *[f"value.{c.split(' ')[0]}" for c in BUCKET.split(", ")])))
    known = lambda c: F.when(F.col(c) != NOTHING, F.col(c))
    return pairs.select(
        F.col("users").alias("user_id"), F.col("items").alias("item_id"),
        F.col("ratings").alias("rating"),
        F.timestamp_add("MICROSECOND", known("times"), F.expr(EPOCH)).alias("ts"),
        known("seqs").alias("seq"))


def live_stats(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``item_id, avg_rating, rating_count``, from the state."""
    # the state names its columns after the aggregates
    return _state(spark, checkpoint, ITEMS).select(
        "key.item_id", (F.col("value.sum") / F.col("value.count")).alias("avg_rating"),
        F.col("value.count").alias("rating_count"))


def live_popular(spark: SparkSession, checkpoint: str, movies: DataFrame,
                 k: int = config.POPULAR_N, min_count: int = 0) -> DataFrame:
    """The popularity list (``k`` rows) by the statistics in the state."""
    cat = movies.select("item_id", "title").join(live_stats(spark, checkpoint), "item_id")
    return popular_items(cat, k, min_count)
