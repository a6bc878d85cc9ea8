"""Quality rules whose cutoffs carry a proven limit on false rejections.

Each rule is a badness score computed from a document's text.  For every
stratum (a column of the documents, the language by default) and rule, a fixed
grid of cutoffs is walked from the most lenient to the strictest.  At each
step all labelled good documents of the stratum are the holdout: with ``n`` of
them and ``k`` above the cutoff, the exact binomial tail ``P(Bin(n, risk) <=
k)`` is the p-value of "this cutoff rejects more than ``risk`` of the good
documents".  The walk stops at the first p-value above ``delta / (strata *
rules)``; the last cutoff before it is used, and a rule without one is off in
that stratum.  Walking in a fixed order needs no further correction along the
grid, and the division corrects over strata and rules, so with probability at
least ``1 - delta`` no chosen cutoff rejects more than ``risk`` of the good
documents of any stratum.

Defined results: null and blank texts have no words and fail the base rule; a
null stratum is a stratum of its own; labels with a null document, a null
quality or no document are ignored; where a document is labelled more than
once, one good label makes it good; a repeated ``doc_id`` is judged row by row
and each of its rows takes the label; with no labels only the base rule acts.
Extra columns of any name are kept by ``keep_good`` and ignored by ``judge``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.text import fresh, kept_table, let, words

# Fixed values of the base rule.
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
MAX_REPEAT_PERCENT = 50

# Production parameters of the certified rules.
RISK = 0.005
DELTA = 0.05
# Cutoffs by rule, most lenient first; a document is rejected above its cutoff.
GRID = {
    "symbol_ratio": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeat_ratio": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "word_length": (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 10.0, 9.0, 8.0),
}


def _repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array."""
    def covered(tri):
        same = F.filter(tri, lambda x, i: (
            ((i > 0) & (F.get(tri, i - 1)["h"] == x["h"]))
            | F.coalesce(F.get(tri, i + 1)["h"] == x["h"], F.lit(False))))
        spots = F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(spots))

    def tally(h):
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(tagged, covered))

    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    # with fewer words there is one window at most
    return F.when(F.size(ws) < 4, F.lit(0)).otherwise(let(windows(ws), tally))


def measures(text: Column) -> Column:
    """Struct of the base counts of a text (all long)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")

    def counts(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.size(F.split(t, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
                ).alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"))
    return let(words(text), counts)


def scores(m: Column) -> dict[str, Column]:
    """The badness score of each certified rule, from a struct of ``measures``."""
    def ratio(a, b):
        return F.coalesce(F.try_divide(m[a].cast("double"), m[b].cast("double")), F.lit(0.0))
    return {"symbol_ratio": ratio("n_symbols", "word_chars"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "word_length": ratio("word_chars", "n_words")}


def base_failed(m: Column) -> Column:
    return ((m["n_words"] < MIN_WORDS)
            | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]))


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """``P(Bin(n, risk) <= k)``, summed in logarithms; 1 where ``k`` exceeds the mean."""
    odds = math.log(risk / (1 - risk))
    first = n * math.log(1 - risk)

    def step(acc, j):
        t = acc["t"] + F.log((n - j + 1) / j) + odds
        return F.struct(t.alias("t"),
                        (F.greatest(acc["s"], t)
                         + F.log1p(F.exp(-F.abs(acc["s"] - t)))).alias("s"))
    total = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k))
                        .otherwise(F.array().cast("array<long>")),
                        F.struct(first.alias("t"), first.alias("s")), step,
                        lambda acc: F.exp(acc["s"]))
    return F.when(k > n * risk, F.lit(1.0)).otherwise(total)


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
            grid: dict = GRID) -> DataFrame:
    """Certified cutoffs: one row per stratum that has good labels.

    ``measured`` has ``doc_id``, ``stratum`` and ``m`` (a struct of
    ``measures``).  The row holds a map from rule to cutoff, without the rules
    that are off, and ``n_good``.
    """
    good = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.max("quality").alias("q")).filter("q = 1")
            .select(F.col("doc_id").cast("long").alias("doc_id")))
    s = scores(F.col("m"))
    held = measured.join(good, "doc_id").select(
        "stratum", *[v.alias(k) for k, v in s.items()])
    steps = [(r, i, float(c)) for r, cs in grid.items() for i, c in enumerate(cs)]
    per = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), F.array(*[
        F.sum((F.col(r) > c).cast("long")) for r, _, c in steps]).alias("ks"))
    level = F.lit(delta) / (F.expr("count(*) over ()") * len(grid))
    # one row per stratum, then one per stratum and step of the grid
    rows = F.transform(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"),
                                          F.lit(c).alias("cut")) for r, i, c in steps]),
                       lambda s, j: F.struct(s["rule"].alias("rule"), s["i"].alias("i"),
                                             s["cut"].alias("cut"), F.col("ks")[j].alias("k")))
    walk = (per.withColumn("level", level).select("stratum", "n_good", "level", F.inline(rows))
            .withColumn("passed", binomial_tail(F.col("n_good"), F.col("k"), risk)
                        <= F.col("level")))
    last = walk.groupBy("stratum", "n_good", "rule").agg(
        F.min(F.when(~F.col("passed"), F.col("i"))).alias("stop"),
        F.sort_array(F.collect_list(F.struct("i", "cut"))).alias("cuts"))  # the grid's length
    return last.groupBy("stratum", "n_good").agg(F.map_from_entries(F.collect_list(F.when(
        F.coalesce(F.col("stop"), F.size("cuts")) > 0,
        F.struct("rule", F.element_at(
            "cuts", F.coalesce(F.col("stop"), F.size("cuts")))["cut"])))).alias("cuts"))


def _passes(m: Column, cuts: Column, rules) -> Column:
    ok = ~base_failed(m)
    for rule, score in scores(m).items():
        if rule in rules:
            ok = ok & F.coalesce(score <= cuts[rule], F.lit(True))
    return ok


def measured_documents(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    part = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       part.cast("string").alias("stratum"),
                       measures(F.col("text")).alias("m"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
          delta: float = DELTA, grid: dict = GRID) -> DataFrame:
    """One row per document row: base counts, ``base_failed`` and ``kept``."""
    measured = kept_table(measured_documents(docs, stratum))
    cuts = cutoffs(measured, labels, risk, delta, grid).withColumnRenamed("stratum", "s")
    m = F.col("m")
    return (measured.join(cuts, F.col("stratum").eqNullSafe(F.col("s")), "left")
            .select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
                    "m.n_repeat_words", base_failed(m).alias("base_failed"),
                    _passes(m, F.col("cuts"), grid).alias("kept")))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
              delta: float = DELTA, grid: dict = GRID) -> DataFrame:
    """The documents that ``judge`` keeps, with their columns; no text is shuffled."""
    measured = kept_table(measured_documents(docs, stratum))
    s, c = (fresh(docs, x) for x in ("_s", "_cuts"))
    # written, so that its real size, a row per stratum, decides how it is joined
    cuts = kept_table(cutoffs(measured, labels, risk, delta, grid).select(
        F.col("stratum").alias(s), F.col("cuts").alias(c)))
    part = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None)
    return (docs.join(cuts, part.eqNullSafe(F.col(s)), "left")
            .filter(let(measures(docs["text"]), lambda m: _passes(m, F.col(c), grid)))
            .select(*[docs[x] for x in docs.columns]))
