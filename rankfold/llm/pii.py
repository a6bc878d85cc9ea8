"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The base finds emails, IP addresses, card numbers and phone numbers in the whole
text; per kind matches are the leftmost ones that do not overlap, and a match
that fails its kind's test is dropped without a retry.

From there contexts are learnt.  Base matches are seeds.  A mention is a seed or
any other word that looks like an identifier (``MIN_LENGTH`` characters or more,
with four digits or an @, without outer punctuation).  Its lexical patterns are
the two words before it, and the word before with the word after it.  Patterns
and mentioned strings form a graph that Spark scores for ``ITERATIONS`` rounds:

* a pattern's confidence is the sum of the scores of the strings it surrounds, over
  the places of the corpus where it occurs: those with any other word count in full
  against it, those with a string that looks like an identifier and is not known to be
  one by ``UNKNOWN``, since that is just what is looked for.  A pattern is used if that is ``MIN_CONFIDENCE`` or more and ``MIN_SUPPORT`` different
  strings of score one half or more support it;
* a string's score is 1 for a seed, else ``1 - prod(1 - confidence)`` over its
  used patterns.

Mentions of strings that end with ``MIN_SCORE`` or more are added as spans of
kind ``context``; base spans stay as they are.

Defined results: null and blank texts have no spans; rows repeated in full count
as often as they occur and get the same spans; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.bits import filter_bits, passes
from rankfold.llm.repeats import identified
from rankfold.llm.text import kept_table, written_table
from rankfold.session import ship_package

# Production parameters.
ITERATIONS = 3
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.8
MIN_LENGTH = 6
UNKNOWN = 0.25

# Fixed values of the base, by kind in order.
KINDS = ("email", "ip", "card", "phone", "context")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match from within a run of digits fails or succeeds as one from its start does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OUTER = ".,;:!?\"'()[]{}<>|=*#"

MENTION = "seed:boolean,inst:string,a:int,b:int,left:long,frame:long,multi:boolean"
FOUND = (f"doc_id long, doc long, tie long, base array<struct<kind:int,a:int,b:int>>, "
         f"mentions array<struct<{MENTION}>>")


# ---------------------------------------------------------------- base
def emails(text: str):
    """Leftmost matches, found from each @ in linear time: what precedes it in its run of
    local characters, and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        run = text[free:at]
        a = free + len(run.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) in code points, by start, then kind."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def mentions(text: str, base: list, h: np.ndarray) -> list[dict]:
    """Seeds and identifier-like words with the patterns around them; ``h`` has the hash
    of each word."""
    spans = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in spans]
    found = [(True, a, b) for _, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    for a, b in spans:
        w = text[a:b]
        core = w.strip(_OUTER)
        if len(core) >= MIN_LENGTH and ("@" in core or sum(c in "0123456789" for c in core) >= 4):
            a += len(w) - len(w.lstrip(_OUTER))
            b = a + len(core)
            i = bisect_left(taken, (b, 0))
            if not any(x < b and y > a for x, y in taken[max(0, i - 4):i]):
                found.append((False, a, b))
    out = []
    for seed, a, b in found:
        i, j = bisect_right(starts, a) - 1, bisect_left(starts, b)
        left = hashing.windows(h[i - 2:i], (0, 1), 1)[0] if i >= 2 else None
        frame = (hashing.windows(np.array([h[i - 1], 0, h[j]], np.uint64), (0, 2), 2)[0]
                 if i >= 1 and j < len(h) else None)
        out.append({"seed": seed, "inst": text[a:b].lower(), "a": a, "b": b,
                    "left": None if left is None else int(left.view(np.int64)),
                    "frame": None if frame is None else int(frame.view(np.int64)),
                    "multi": j - i > 1})
    return out


def find(docs: DataFrame) -> DataFrame:
    """Per document row: base spans and mentions."""
    ship_package(docs.sparkSession)
    digit_or_at = np.zeros(256, bool)
    digit_or_at[48:58] = digit_or_at[64] = True

    def spans(batches):
        for b in batches:
            base: list[list] = [[] for _ in range(b.num_rows)]
            seen: list[list] = [[] for _ in range(b.num_rows)]
            for lo, _, data, off in hashing.slices(b.column(3)):
                count = np.concatenate([[0], np.cumsum(digit_or_at[data])])
                for r in np.flatnonzero(count[off[1:]] > count[off[:-1]]).tolist():
                    raw = data[off[r]:off[r + 1]]
                    text = raw.tobytes().decode()
                    own = base_spans(text)
                    s, e, _ = hashing.word_spans(raw, np.array([0, len(raw)]))
                    base[lo + r] = [{"kind": k, "a": x, "b": y} for k, x, y in own]
                    seen[lo + r] = mentions(text, own, hashing.word_hashes(raw, s, e, True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array(base, _BASE_TYPE), pa.array(seen, _MENTION_TYPE)],
                names=["doc_id", "doc", "tie", "base", "mentions"])
    return identified(docs).select("doc_id", "doc", "tie", "text").mapInArrow(spans, FOUND)


_BASE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32())]))
_MENTION_TYPE = pa.list_(pa.struct([
    ("seed", pa.bool_()), ("inst", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
    ("left", pa.int64()), ("frame", pa.int64()), ("multi", pa.bool_())]))


# ---------------------------------------------------------------- contexts
def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, n): in how many places each of ``patterns`` surrounds a word.

    Tasks count the patterns that pass a filter of fixed size, batch by batch.
    """
    bits = docs.sparkSession.sparkContext.broadcast(
        filter_bits(patterns.select(F.col("pattern").alias("key"))))

    def count(batches):
        for b in batches:
            for _, _, data, off in hashing.slices(b.column(0)):
                s, e, first = hashing.word_spans(data, off)
                h = hashing.word_hashes(data, s, e, True)
                last = first[1:][np.repeat(np.arange(len(off) - 1), np.diff(first))]
                got = []
                for offsets, salt in (((0, 1), 1), ((0, 2), 2)):
                    p = hashing.windows(h, offsets, salt)
                    p = p[np.arange(len(p)) + 2 < last[:len(p)]]
                    got.append(p[passes(bits.value, p)])
                p, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(n)],
                                                 names=["pattern", "n"])
    return (docs.select("text").mapInArrow(count, "pattern long, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")).join(patterns, "pattern"))


def score(edges: DataFrame, total: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(inst, score) of the strings that are no seeds, after ``iterations`` rounds.

    ``edges``: (pattern, inst, seed, n), once per pair; ``total``: (pattern, n).
    """
    graph = kept_table(edges.join(total.select("pattern", F.col("n").alias("of")), "pattern"))
    first = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = graph.withColumn("score", first)
    for _ in range(iterations):
        good = F.sum(F.col("score") * F.col("n"))
        open_ = F.sum((1 - F.col("score")) * F.col("n")) * UNKNOWN
        other = F.greatest(F.max("of") - F.sum("n"), F.lit(0))
        patterns = scored.groupBy("pattern").agg(
            F.coalesce(F.try_divide(good, good + open_ + other), F.lit(0.0)).alias("confidence"),
            F.sum((F.col("score") >= 0.5).cast("long")).alias("support")).filter(
            (F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
        strings = kept_table(graph.filter(~F.col("seed")).join(patterns, "pattern")
                             .groupBy("inst").agg((1 - F.exp(F.sum(F.log(F.greatest(
                                 1 - F.col("confidence"), F.lit(1e-12)))))).alias("got")))
        scored = graph.join(strings, "inst", "left").withColumn(
            "score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("got", F.lit(0.0))))
    return strings.select("inst", F.col("got").alias("score"))


def learn(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(inst, score) of the strings that the learnt contexts show to be identifiers."""
    said = found.select(F.inline("mentions")).select(
        "seed", "inst", "multi", F.explode(F.array(
            F.struct(F.lit(0).alias("t"), F.col("left").alias("p")),
            F.struct(F.lit(1).alias("t"), F.col("frame").alias("p")))).alias("x")).select(
        F.col("x.p").alias("pattern"), "inst", "seed",
        (F.col("multi") & (F.col("x.t") == 1)).alias("wide")).filter("pattern is not null")
    edges = kept_table(said.groupBy("pattern", "inst").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("wide").cast("long")).alias("wide")))
    # a pattern is used only if several strings support it; what surrounds just seeds or
    # fewer strings adds nothing
    useful = kept_table(edges.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("c"), F.sum("wide").alias("wide"),
        F.max((~F.col("seed")).cast("int")).alias("new")).filter(
        (F.col("c") > MIN_SUPPORT) & (F.col("new") == 1)).select("pattern", "wide"))
    total = occurrences(docs, useful).select(
        "pattern", (F.col("n") + F.col("wide")).alias("n"))
    return score(edges.select("pattern", "inst", "seed", "n"), total).filter(
        F.col("score") >= MIN_SCORE)


def _count_of(kind: int) -> Column:
    """How many base spans are of one kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def detect(docs: DataFrame) -> DataFrame:
    """One row per document row: counts and hash of the base spans, and all spans."""
    found = written_table(find(docs), "mentions")
    strings = learn(docs, found).select("inst")
    more = (found.select("doc", "tie", F.inline("mentions")).filter("not seed")
            .join(strings, "inst").groupBy(F.col("doc").alias("_d"), F.col("tie").alias("_t"))
            .agg(F.collect_set(F.struct(F.col("a"), F.lit(len(KINDS) - 1).alias("kind"),
                                        F.col("b"))).alias("more")))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", kinds[s["kind"]], s["a"], s["b"])), ",")
    base = F.transform("base", lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"),
                                                  s["b"].alias("b")))
    every = F.concat(base, F.coalesce("more", F.array().cast(
        "array<struct<a:int,kind:int,b:int>>")))
    counts = [_count_of(k).alias(f"n_{KINDS[k]}") for k in range(4)]
    return (found.drop("mentions")
            .join(more, (F.col("doc") == F.col("_d")) & (F.col("tie") == F.col("_t")), "left")
            .select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                    joined(every).alias("spans")))
