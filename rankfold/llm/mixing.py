"""Mixing sources to target weights by Pareto order sampling.

Sizes are words.  A source's target is its share, by weight, of all words, but
at most ``max_repeats`` times what it has; the excess goes to the sources still
below their limit, by weight, until none is above.

Within a source a document expects ``e = target / source size`` copies, scaled
by its importance if a column for that is given.  Its whole part, ``floor(e)``
copies, is certain.  For the rest, ``p = e - floor(e)``, documents are ranked
by the Pareto order variable ``(u / (1 - u)) / (p / (1 - p))``, with ``u`` a
uniform number from a hash of ``doc_id`` and seed, and one further copy is
taken of the first ones until the words still missing from the target are
reached.  Ranking is by counts: the order variable is cut into bins, sums of
bins (a bounded number per source) show the bin in which the target is
reached, only that bin is cut again, and only the rows of the last bin are
sorted, a ``BINS ** -2`` part of a source.  The outcome is one row per source:
its target and the last rank taken.

Defined results: null and blank texts have size 0 and take part (0 words); a
source of size 0 has target 0 and gives nothing; null sources are one source,
last in order; documents equal in rank are ordered by ``doc_id`` (null first)
and text hash; rows equal in both are taken alike; an empty table gives no
rows; extra columns are ignored by ``allocate`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.text import fresh, kept_table, let, words

# Fixed values of the mix: weights by source in order, and the repeat limit.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

# Production parameters.
SEED = 7
BINS = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS
                   ) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``target``.

    ``sizes`` has one row per source, so a window over it holds sources, not
    documents.  Targets are ``weight * unit`` or the limit, and the sources at their
    limit are those with the least limit per weight.  So in that order the unit is what
    the sources before leave of all words, per weight not theirs, at the first source
    that stays below its limit with it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    src = kept_table(sizes.select("source", "source_size").withColumn(
        "weight", F.element_at(w, ((F.row_number().over(order) - 1) % len(weights) + 1))))
    limit = F.col("source_size").cast("double") * max_repeats
    rise = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    left = (F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    own = src.withColumns({"_nth": F.row_number().over(rise), "_unit": left / weight})
    unit = F.min(F.when(limit > F.col("weight") * F.col("_unit"),
                        F.struct("_nth", "_unit"))).over(every)["_unit"]
    return own.withColumn("target", F.coalesce(F.least(limit, F.col("weight") * unit), limit)
                          ).drop("_nth", "_unit")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 of seed and id."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)),
                            F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)


def _ranked(docs: DataFrame, importance: str | None) -> DataFrame:
    """Sizes and keys of the documents, without their texts."""
    imp = (F.greatest(F.coalesce(F.col(importance).cast("double"), F.lit(0.0)), F.lit(0.0))
           if importance else F.lit(1.0))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"), imp.alias("imp"),
        F.xxhash64("text").alias("tie"))


def _copies(r: dict[str, Column], s: dict[str, Column], max_repeats: int, seed: int
            ) -> tuple[Column, Column]:
    """Certain copies of a document, and its rank key (null: nothing beyond them).

    The key starts with the order variable mapped to [0, 1) without changing the
    order and cut into ``BINS ** 2`` bins.
    """
    e = F.least(F.coalesce(F.try_divide(s["target"], s["mass"]), F.lit(0.0)) * r["imp"],
                F.lit(float(max_repeats)))
    u = uniform(r["doc_id"], seed)

    def key(p):
        odds = (u / (1 - u)) / (p / (1 - p))
        q = odds / (1 + odds)
        return F.when(p > 0, F.struct(
            F.least(F.floor(q * BINS * BINS), F.lit(BINS * BINS - 1)).alias("bin"),
            q.alias("q"), F.coalesce(r["doc_id"], F.lit(-2 ** 63)).alias("doc_id"),
            r["tie"].alias("tie")))
    return F.floor(e).cast("long"), let(e - F.floor(e), key)


def source_plan(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
                seed: int = SEED, importance: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sized documents, one row per source with target, mass and last rank key taken)."""
    sized = kept_table(_ranked(docs, importance))
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum(F.col("size") * F.col("imp")).alias("mass"))
    mass = per.select(F.col("source").alias("_s"), "mass")
    plan = kept_table(source_targets(per, weights, max_repeats).join(
        mass, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), "source_size", "target", "mass"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    whole, key = _copies(_cols(sized), _cols(plan), max_repeats, seed)
    ranked = kept_table(sized.join(plan, same).select(
        "source", "size", "target", whole.alias("whole"), key.alias("key")))
    want = ranked.groupBy(F.col("source").alias("_s")).agg(
        (F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("missing"))
    rows = ranked.filter("key is not null").select("source", "size", "key")
    for part in (F.floor(F.col("key.bin") / BINS), F.col("key.bin") % BINS):
        cut = rows.withColumn("_bin", part)
        run = Window.partitionBy("source").orderBy("_bin").rowsBetween(
            Window.unboundedPreceding, -1)
        # BINS rows per source at most; the target is reached in the last bin begun below it
        sums = cut.groupBy("source", "_bin").agg(F.sum("size").alias("_n"))
        begun = (sums.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
                 .join(want, same).filter(F.col("_before") < F.col("missing"))
                 .groupBy("_s").agg(F.max(F.struct(
                     "_bin", (F.col("missing") - F.col("_before")).alias("left"))).alias("b")))
        want = kept_table(begun.select("_s", F.col("b._bin").alias("_open"),
                                       F.col("b.left").alias("missing")))
        rows = cut.join(want.select("_s", "_open"), same).filter("_bin = _open").select(
            "source", "size", "key")
        want = want.select("_s", "missing")
    # what is left of a source is one of its BINS * BINS bins
    run = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    near = (rows.withColumn("_before", F.coalesce(F.sum("size").over(run), F.lit(0)))
            .join(want, same)
            # no more than half of it past the target: nearer with it than without it
            .withColumn("fits", F.col("_before") + F.col("size") / 2 <= F.col("missing")))
    floor = F.struct(F.min("key.bin").alias("bin"), F.lit(-1.0).alias("q"),
                     F.lit(-2 ** 63).alias("doc_id"), F.lit(-2 ** 63).alias("tie"))
    last = near.groupBy(F.col("source").alias("_l")).agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("key"))), floor).alias("last"))
    return sized, kept_table(plan.join(last, F.col("_s").eqNullSafe(F.col("_l")), "left")
                             .drop("_l"))


def _cols(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def _taken(r: dict, s: dict, max_repeats: int, seed: int) -> Column:
    whole, key = _copies(r, s, max_repeats, seed)
    return whole + F.coalesce((key <= s["last"]).cast("long"), F.lit(0).cast("long"))


def allocate(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
             seed: int = SEED, importance: str | None = None) -> DataFrame:
    """One row per document row: ``doc_id``, ``size``, ``source``, ``source_size``,
    ``target``, ``copies`` and ``taken`` (copies times size)."""
    sized, plan = source_plan(docs, weights, max_repeats, seed, importance)
    copies = _taken(_cols(sized), _cols(plan), max_repeats, seed)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
        importance: str | None = None) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with their columns.

    Only the table of sources is joined to the documents, so no text is moved
    unless there are more sources than a broadcast holds.
    """
    _, plan = source_plan(docs, weights, max_repeats, seed, importance)
    names = {c: fresh(docs, f"_{c}") for c in plan.columns}
    plan = plan.select(*[F.col(c).alias(n) for c, n in names.items()])
    n = fresh(docs, "_n")
    r = {"doc_id": docs["doc_id"].cast("long"), "tie": F.xxhash64(docs["text"]),
         "imp": F.greatest(F.coalesce(docs[importance].cast("double"), F.lit(0.0)), F.lit(0.0))
         if importance else F.lit(1.0)}
    copies = _taken(r, {c: F.col(x) for c, x in names.items()}, max_repeats, seed)
    one = F.lit(1).cast("long")
    return (docs.join(plan, docs["source"].cast("string").eqNullSafe(F.col(names["_s"])))
            .withColumn(n, copies).filter(F.col(n) > 0)
            .withColumn(n, F.explode(F.sequence(one, F.col(n))))
            .select(*[docs[c] for c in docs.columns]))
