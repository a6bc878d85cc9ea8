"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0 .. n-1 in ``doc_id`` order (nulls first, ties by text
checksum and size).  The number is split as ``(left, right)`` in mixed radix
``a * b``, with ``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``, and a Feistel
network of modular additions permutes ``[0, a * b)``.  A result of ``n`` or
more is fed back in until it falls below ``n`` (cycle walking), which gives a
permutation of ``[0, n)``.  From the permuted number ``p`` follow ``shard = p
mod shards`` and ``slot = p div shards``, so any row's place is computable
from its number alone, shards differ by one row at most (law ``rows``) and
slots have no gaps.

Defined results: null texts have no bytes and the checksum of the empty text;
null ``doc_id`` come first; equal rows are interchangeable; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.text import kept_table

# Production parameters.
SHARDS = 24
SEED = 20240
ROUNDS = 8

# Fixed values of the round function: odd multipliers below 2^31, modulus 2^31 - 1.
MULTIPLIER = 1103515245
STEP = 40503
MODULUS = 2147483647
MAX_WALK = 64


def row_numbers(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with a gapless long ``row_number`` in ``order``, without a window
    over all rows: a range partitioning, a number in each partition, and the
    counts of the partitions before it (one row per partition)."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key only spreads equal rows over partitions
    local = kept_table(
        rows.withColumn("_last", F.monotonically_increasing_id())
        .repartitionByRange(n, *order, "_last").sortWithinPartitions(*order, "_last")
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()
                    - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_last"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn("row_number", F.col("_off") + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def radices(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _mix(x: Column, j: Column, seed: int) -> Column:
    """Round function: twice a multiplication modulo a prime, the key between."""
    y = (x * MULTIPLIER + (j + 1) * STEP + seed) % MODULUS
    z = (F.shiftright(y, 15).bitwiseXOR(y) * MULTIPLIER + seed) % MODULUS
    return F.shiftright(z, 13).bitwiseXOR(z)


def feistel(p: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """One pass of the permutation of ``[0, a * b)`` over a long column."""
    a, b = radices(n)

    def step(s, j):
        return F.when(j % 2 == 0, F.struct(
            ((s["l"] + _mix(s["r"], j, seed)) % a).alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), ((s["r"] + _mix(s["l"], j, seed)) % b).alias("r")))
    start = F.struct(F.floor(p / F.lit(b)).cast("long").alias("l"), (p % b).alias("r"))
    if n >= 1 << 52:
        start = F.struct(((p - p % b) / F.lit(b)).cast("long").alias("l"), (p % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(rounds - 1).cast("long")),
                       start, step, lambda s: s["l"] * b + s["r"])


def permuted(p: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The permutation of ``[0, n)``: ``feistel`` with cycle walking.

    Of ``a * b`` numbers fewer than ``a`` are out of range, so a walk returns
    after at most as many steps.  Where that is over ``MAX_WALK``, a walk longer
    than ``MAX_WALK`` has odds below ``n ** -32`` and raises an error.
    """
    a, b = radices(n)
    steps = min(a * b - n, MAX_WALK)
    first = feistel(p, n, seed, rounds)
    if not steps:
        return first
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first,
                         lambda x, _: F.when(x < n, x).otherwise(feistel(x, n, seed, rounds)))
    return F.transform(F.array(walked), lambda x: F.when(x < n, x).otherwise(
        F.raise_error(F.lit("cycle walk too long")).cast("long")))[0]


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
           rounds: int = ROUNDS) -> DataFrame:
    """One row per document row with its shard and slot (law ``rows``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    numbered = row_numbers(rows, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"),
                                  F.col("size")])
    n = numbered.count()
    p = permuted(F.col("row_number"), n, seed, rounds)
    return (numbered.withColumn("_p", p)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    (F.col("_p") % shards).cast("int").alias("shard"),
                    F.expr(f"_p div {shards}").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "row_number"))
