"""Quality rules, licence scan, mixing and sharding against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F
from rankfold.llm import licences, mixing, quality, shards
from tests.llm.conftest import DOCS, all_rows, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(tri)
    spots = {i + k for i, x in enumerate(tri) if often[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(spots))


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_quality_measures_match_brute_force(spark, edge_docs, clash_docs, no_docs):
    small = [("a b a b a",), ("a a a a",), ("a a a",), ("a b c a b",), ("a b c a b c",), ("a",),
             ("a b a b a b a",), ("x y z x y q x y z",), ("a a a a b",), ("b a a a a",)]
    rng = random.Random(3)
    small += [(" ".join(rng.choices("ab", k=n)),) for n in range(9) for _ in range(10)]
    more = spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, (t,) in enumerate(small)], DOCS)
    docs = edge_docs.unionByName(more)
    got = all_rows(quality.judge(docs, no_labels(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept"))
    want = []
    for r in rows() + [(100 + i, t) for i, (t,) in enumerate(small)]:
        b = base(r[1])
        fail = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((r[0], *b, fail, not fail))
    assert got == sorted(want, key=repr)
    assert all_rows(quality.judge(clash_docs, no_labels(spark))) == all_rows(
        quality.judge(edge_docs, no_labels(spark)))
    assert quality.judge(no_docs, no_labels(spark)).count() == 0
    kept = quality.keep_good(clash_docs, no_labels(spark))
    assert kept.columns == clash_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [8, 9]


def test_binomial_tail_is_exact(spark):
    cases = [(1, 0), (10, 0), (50, 1), (400, 3), (5000, 20), (200000, 900), (10, 9)]
    df = spark.createDataFrame(cases, "n long, k long")
    for r in df.withColumn("p", quality.binomial_tail(F.col("n"), F.col("k"), 0.005)).collect():
        if r.k > r.n * 0.005:
            assert r.p == 1.0
            continue
        logs = [math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1)
                + j * math.log(0.005) + (r.n - j) * math.log(0.995) for j in range(r.k + 1)]
        assert r.p == pytest.approx(sum(map(math.exp, logs)), rel=1e-6)


def test_cutoffs_limit_false_rejection_per_stratum(spark):
    def text(i, symbols):
        return " ".join(f"w{i}q{k}" for k in range(60)) + " " + "#" * symbols
    docs = [(i, text(i, 0 if i % 50 else 30), "en", "s", 1) for i in range(3000)]
    docs += [(i, text(i, 0), "fr", "s", 1) for i in range(3000, 3100)]
    docs += [(4000, text(4000, 200), "en", "s", 1), (4001, text(4001, 200), "fr", "s", 1)]
    labels = [(i, 1, 0) for i in range(3100)] + [(4000, 0, 0), (7, None, 0), (None, 1, 0), (8, 0, 0)]
    d = spark.createDataFrame(docs, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    m = quality.measured_documents(d)
    cuts = {r.stratum: r for r in quality.cutoffs(m, lab).collect()}
    assert cuts["en"].n_good == 3000 and cuts["fr"].n_good == 100
    # 2 % of the good documents have a symbol ratio between 0.06 and 0.08: no cutoff below it is proven
    assert cuts["en"].cuts["symbol_ratio"] == 0.08
    assert cuts["fr"].cuts == {}
    kept = {r.doc_id for r in quality.judge(d, lab).filter("kept").collect()}
    assert 4000 not in kept and 4001 in kept and len(kept) >= 3090


def dice_brute(text, threshold):
    def grams(t):
        w = re.sub(r"[^\w]|_", " ", t.lower()).split()
        return set(zip(w, w[1:]))
    t = text or ""
    units = dict.fromkeys([t, *re.split(r"\n[ \t\r]*\n\s*", t), *t.split("\n")])
    best, n = None, set()
    for k, u in enumerate(units):
        a = grams(u)
        for name, ts in licences.TEMPLATES.items():
            for b in map(grams, ts):
                if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                    n.add(k)
                    s = (-2 * len(a & b) / (len(a) + len(b)), name, k)
                    best = min(best or s, s)
    return len(n), best


def test_licences_match_brute_force(spark, edge_docs, clash_docs, no_docs):
    mit = licences.TEMPLATES["MIT"][1]
    texts = ["Released under the MIT License.", "some words\nreleased UNDER the mit licence\nend",
             mit, mit.replace("software", "program"), "intro\n\n" + mit.replace(", ", ",\n") + "\n\nend",
             "This work is licensed under the GNU General Public License, version 9.",
             "Licensed under CC BY-NC 4.0.", "word", ""]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in licences.classify(d).collect()}
    for i, t in enumerate(texts):
        n, best = dice_brute(t, licences.THRESHOLD)
        assert got[i].n_units == n, t
        assert got[i].licence == (best and best[1])
        assert got[i].dice == (best and pytest.approx(-best[0]))
    assert got[0].licence == "MIT" and got[4].licence == "MIT" and got[7].licence is None
    assert all_rows(licences.classify(edge_docs)) == all_rows(licences.classify(clash_docs))
    assert licences.classify(edge_docs).count() == len(rows())
    assert licences.classify(no_docs).count() == 0


def test_licences_of_rows_that_share_an_id(spark):
    mit = licences.TEMPLATES["MIT"][0]
    docs = [(None, mit), (None, "hello there you world"), (7, mit), (7, "nothing at all here"),
            (7, mit), (None, None)]
    got = licences.classify(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.licence) for r in got.collect()), key=repr) == sorted(
        [(None, "MIT"), (None, None), (None, None), (7, "MIT"), (7, None), (7, "MIT")], key=repr)


def window_brute(text, template, threshold):
    """Best score of the windows from the start of a run of template bigrams to the end of
    the same run, or of a later one within reach of the notice's length."""
    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return list(zip(w, w[1:]))
    g, t = grams(text), grams(template)
    tb, most = set(t), (2 - threshold) / threshold
    best, low, high = 0.0, max(1, math.ceil(len(tb) / most - 1e-9)), math.floor(
        len(t) * most + 1e-9)
    runs = [(i, next(j for j in range(i, len(g)) if j + 1 == len(g) or g[j + 1] not in tb))
            for i in range(len(g)) if g[i] in tb and (i == 0 or g[i - 1] not in tb)]
    for a, (i, _) in enumerate(runs):
        for b, (_, j) in enumerate(runs[a:]):
            if b and j - i >= high:
                continue
            x = set(g[i:j + 1])
            if sum(c in tb for c in g[i:j + 1]) < low:
                continue
            opens, ends = i == 0 or t[0] in x, j == len(g) - 1 or t[-1] in x
            size = len(x) if opens and ends else max(len(x), len(tb))
            best = max(best, 2 * len(x & tb) / (size + len(tb)))
    return best


def test_windows_match_brute_force(spark):
    """The window search against every window of random texts with parts of notices."""
    rng = random.Random(11)
    templates = {"one": (" ".join(f"a{i}" for i in range(14)),),
                 "two": (" ".join(f"a{i % 9}" for i in range(20, 41)),)}
    texts = []
    for _ in range(150):
        w = [f"z{rng.randint(0, 9)}" for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(1, 2)):
            t = templates[rng.choice(["one", "two"])][0].split()
            a = rng.randint(0, 3)
            t = t[a:len(t) - rng.randint(0, 3)]
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = "q"
            if rng.random() < 0.3:
                t[len(t) // 2:len(t) // 2] = ["q"] * rng.randint(1, 4)
            w += t + [f"z{rng.randint(0, 9)}" for _ in range(rng.randint(0, 8))]
        texts.append(" ".join(w))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.licence): r.dice for r in
           licences.embedded(d, templates, licences.THRESHOLD).collect()}
    want = {(i, name): s for i, t in enumerate(texts) for name, (x,) in templates.items()
            if (s := window_brute(t, x, licences.THRESHOLD)) >= licences.THRESHOLD}
    assert len(want) > 40 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_licences_inside_longer_text(spark):
    head = ("This {} is free software; you can redistribute it and/or modify it under the terms of "
            "the GNU {} as published by the Free Software Foundation; either version {} of the "
            "License, or (at your option) any later version.")
    apache, mit = licences.TEMPLATES["Apache-2.0"][1], licences.TEMPLATES["MIT"][1]
    cases = [("This project is released under the MIT License.", "MIT"),
             ("Copyright 2020 by us. " + mit + " It is of use to many of the people here.", "MIT"),
             ("a b c " * 400 + apache.replace("express or implied", "implied") + " d e" * 900,
              "Apache-2.0"),
             ("so " + mit.replace("to deal in the Software without restriction, ", "") + " and on",
              "MIT"),
             (head.format("program", "General Public License", "2"), "GPL-2.0"),
             ("# " + head.format("program", "General Public License", "3") + " More of it.", "GPL-3.0"),
             (head.format("library", "Lesser General Public License", "2.1"), "LGPL-2.1"),
             (head.format("program", "Lesser General Public License", "3"), "LGPL-3.0"),
             (head.format("program", "Affero General Public License", "3"), "AGPL-3.0"),
             (" x".join(licences.TEMPLATES["BSD-3-Clause"][1:]) + " y z" * 300, "BSD-3-Clause"),
             ("it was released under the new name and the mit license " * 50, None)]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, (t, _) in enumerate(cases)], DOCS)
    got = {r.doc_id: r for r in licences.classify(d).collect()}
    for i, (t, name) in enumerate(cases):
        assert got[i].licence == name, t[:100]
        assert (got[i].n_units > 0) == (name is not None)
    assert got[0].dice == 1.0 and got[1].dice == 1.0 and 0.9 < got[3].dice < 1.0


def water(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if t[s] >= cap * sizes[s]}
        if not over:
            return {**t, **{s: cap * sizes[s] for s in full}}
        full |= over


def test_mix_reaches_targets(spark, edge_docs, clash_docs, no_docs):
    docs = []
    for i in range(3000):
        s = None if i % 37 == 0 else f"s{min(i % 17, 5)}"
        docs.append((i, "w " * (1 + (i * 7919) % 300), "en", s, 1))
    d = spark.createDataFrame(docs, DOCS)
    got = mixing.allocate(d).collect()
    sizes = defaultdict(int)
    for r in docs:
        sizes[r[3]] += len(WORD.findall(r[1]))
    want = water(sizes)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 300
    assert all_rows(mixing.allocate(d.repartition(7))) == sorted(map(tuple, got), key=repr)
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert copies == {r.doc_id: r.copies for r in got if r.copies}


def test_targets_match_resharing_in_rounds(spark):
    """The closed form against sharing the excess again and again."""
    rng = random.Random(6)
    for n in (1, 2, 3, 7, 20):
        sizes = [rng.choice([0, 1, 5, 40, 1000, 90000]) for _ in range(n)]
        weights = [mixing.WEIGHTS[i % 3] for i in range(n)]
        total, capped = sum(sizes), set()
        while True:
            free = [i for i in range(n) if i not in capped]
            rest = total - sum(3 * sizes[i] for i in capped)
            unit = rest / sum(weights[i] for i in free) if free else 0
            over = {i for i in free if weights[i] * unit > 3 * sizes[i]}
            if not over:
                break
            capped |= over
        want = [3 * sizes[i] if i in capped else weights[i] * unit for i in range(n)]
        df = spark.createDataFrame([(f"s{i:02d}", s) for i, s in enumerate(sizes)],
                                   "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert [got[f"s{i:02d}"] for i in range(n)] == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_mix_importance_is_unequal_probability(spark):
    docs = [(i, "w " * 10, "en", "abc"[i % 3], float(1 + i % 2)) for i in range(6000)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, p double")
    got = mixing.allocate(d, importance="p").collect()
    per = defaultdict(lambda: [0, 0])
    for r in got:
        if r.source == "c":
            per[r.doc_id % 2][0] += r.copies
            per[r.doc_id % 2][1] += 1
    assert per[1][0] / per[0][0] == pytest.approx(2, rel=0.25)


def test_mix_edges(spark, edge_docs, clash_docs, no_docs):
    a = mixing.allocate(edge_docs)
    assert a.count() == len(rows())
    assert all_rows(a) == all_rows(mixing.allocate(clash_docs))
    assert mixing.mix(clash_docs).columns == clash_docs.columns
    assert mixing.allocate(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_shards(spark, edge_docs, clash_docs, no_docs):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("té"), F.col("id")).alias("text"))
    got = shards.assign(docs.repartition(5)).collect()
    per = defaultdict(list)
    for r in got:
        t = f"té{r.doc_id}".encode()
        assert (r["size"], r.text_crc32) == (len(t) + 8, zlib.crc32(t))
        assert r.row_number == r.doc_id and r.grown_shard is None and r.law == "rows"
        per[r.shard].append(r.slot)
    assert set(per) == set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    moved = sum(abs(r.shard + 24 * r.slot - r.row_number) for r in got) / 1000
    assert 250 < moved < 420
    assert all_rows(shards.assign(docs)) == sorted(map(tuple, got), key=repr)
    e = shards.assign(edge_docs)
    assert sorted(r.slot * 24 + r.shard for r in e.collect()) == list(range(len(rows())))
    assert all_rows(e.drop("row_number", "shard", "slot")) == all_rows(
        shards.assign(clash_docs).drop("row_number", "shard", "slot"))
    assert shards.assign(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 25, 97, 1000])
def test_feistel_is_a_permutation(spark, n):
    p = spark.range(n).select(shards.permuted(F.col("id"), n).alias("p")).collect()
    assert sorted(r.p for r in p) == list(range(n))
