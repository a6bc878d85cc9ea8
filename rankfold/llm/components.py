"""Connected components of a graph of pairs, by rounds of contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.text import kept_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long ``a``, ``b``); a component
    is named by its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers
    twice, and replaces the nodes of each edge by where they point; edges within
    one node go.  At least half of the nodes still in an edge go in a round, so
    rounds are logarithmic.  Neighbours are only ever aggregated, so no node's
    neighbours meet in one task.
    """
    cur = kept_table(edges.select("a", "b").filter("a <> b").distinct())
    steps = []
    while not cur.isEmpty():
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select(
            "u", F.least("u", "m").alias("p"))
        for _ in range(2):
            to = kept_table(to)
            up = to.select(F.col("u").alias("v"), F.col("p").alias("q")).filter("q <> v")
            to = to.join(up, F.col("p") == F.col("v"), "left").select(
                "u", F.coalesce("q", "p").alias("p"))
        to = kept_table(to)
        steps.append(to)
        pa = to.select(F.col("u").alias("a"), F.col("p").alias("x"))
        pb = to.select(F.col("u").alias("b"), F.col("p").alias("y"))
        cur = kept_table(cur.join(pa, "a").join(pb, "b").filter("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not steps:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(found, to):
        nxt = to.select(F.col("u").alias("component"), "p")
        return found.join(nxt, "component", "left").select(
            "node", F.coalesce("p", "component").alias("component"))
    first = steps[0].select(F.col("u").alias("node"), F.col("p").alias("component"))
    return kept_table(reduce(follow, steps[1:], first))
