"""Personal data: base patterns against plain regular expressions, learnt contexts."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from rankfold.llm import hashing, pii
from tests.llm.conftest import DOCS, all_rows, rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (2 if i % 2 else 1)
        s += x if x < 10 else x - 9
    return s % 10 == 0


def brute(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_matches_plain_expressions():
    rng = random.Random(3)
    parts = ["a@b.c", "a.b+c@d-e.fr.org", "x@y@z.com", "@", ".", "1.2.3.4", "256.1.1.1",
             "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 010-9999",
             "+12345", " ", "é", "  ", "0", "9", "-", "_", "%", "user", "+", "(", "0099.1.2.003",
             "a@b.c_d@e.f.g", "79927398713", "\n"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        got = [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)]
        assert got == brute(t), t


def test_base_is_linear_on_long_runs():
    t = "7" * 400_000 + " " + "a" * 400_000 + " " + "999." * 100_000 + "@" * 1000
    assert pii.base_spans(t) == []


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_detect_edges_and_clashes(spark, edge_docs, clash_docs, no_docs):
    got = pii.detect(edge_docs)
    want = []
    for r in rows():
        b = brute(r[1] or "")
        n = [sum(s[0] == k for s in b) for k in pii.KINDS[:4]]
        want.append((r[0], *n, hashlib.sha256(joined(b).encode()).hexdigest(), joined(b)))
    assert all_rows(got) == sorted(want, key=repr)
    assert all_rows(pii.detect(clash_docs)) == sorted(want, key=repr)
    assert pii.detect(no_docs).count() == 0


MIXES = ["a@b.co", "10.0.0.1", "4111 1111 1111 1111", "+44 20 7946 0958"]


def test_counts_are_by_kind_whatever_the_order(spark):
    """Every mix of kinds, in every order, each as often as its place says."""
    docs = []
    for n in range(5):
        for mix in itertools.permutations(range(4), n):
            text = " and ".join(MIXES[k] for i, k in enumerate(mix) for _ in range(i + 1))
            docs.append((len(docs), text, "en", "s", 1))
    got = {r.doc_id: r for r in pii.detect(spark.createDataFrame(docs, DOCS)).collect()}
    for d, text, *_ in docs:
        b = brute(text)
        assert tuple(got[d][1:5]) == tuple(sum(s[0] == k for s in b) for k in pii.KINDS[:4]), text
        assert got[d].base_sha256 == hashlib.sha256(joined(b).encode()).hexdigest()


def test_contexts_find_unseen_identifiers(spark):
    docs = [(i, f"some words w{i} then reach me at user{i}@mail.example.com whenever", "en", "s", 1)
            for i in range(20)]
    docs += [(50, "please reach me at user77(at)mail9021.example whenever you can", "en", "s", 1)]
    docs += [(51, "elsewhere user77(at)mail9021.example appears in another place", "en", "s", 1)]
    docs += [(60 + i, f"lot number {90000 + i} of item{90000 + i} is here", "en", "s", 1)
             for i in range(20)]
    got = {r.doc_id: r for r in pii.detect(spark.createDataFrame(docs, DOCS)).collect()}
    assert got[0].n_email == 1 and got[0].spans.startswith("email:")
    for i in (50, 51):
        text = docs[i - 30][1]
        a = text.index("user77")
        assert got[i].spans == f"context:{a}:{a + len('user77(at)mail9021.example')}"
        assert got[i].n_email == 0 and got[i].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(got[60 + i].spans == "" for i in range(20))


def test_many_unseen_identifiers_do_not_hide_each_other(spark):
    """8 of 28 places of one context hold strings that no pattern of the base knows."""
    docs = [(i, f"some words w{i} then reach me at user{i}@mail.example.com whenever", "en", "s", 1)
            for i in range(20)]
    docs += [(50 + i, f"other words w{i} then reach me at user{i}(at)mail901{i}.example whenever",
              "en", "s", 1) for i in range(8)]
    # contexts that mostly hold ordinary words, and numbers in a context of their own
    docs += [(100 + i, f"we met at {w} whenever w{i}", "en", "s", 1)
             for i, w in enumerate(["noon", "home", "work", "12345678", "sea", "night"] * 5)]
    docs += [(200 + i, f"part number {70000 + i} is on the shelf", "en", "s", 1) for i in range(30)]
    got = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(docs, DOCS)).collect()}
    for i in range(8):
        text = docs[20 + i][1]
        a = text.index("user")
        assert got[50 + i] == f"context:{a}:{a + len(f'user{i}(at)mail901{i}.example')}"
    assert all(got[d] == "" for d in got if d >= 100)


def score_brute(edges, total, iterations):
    seed = {i for _, i, s, _ in edges if s}
    score = {i: float(i in seed) for _, i, _, _ in edges}
    for _ in range(iterations):
        conf = {}
        for p in total:
            own = [(i, n) for q, i, _, n in edges if q == p]
            good = sum(score[i] * n for i, n in own)
            open_ = sum((1 - score[i]) * n for i, n in own) * pii.UNKNOWN
            other = max(total[p] - sum(n for _, n in own), 0)
            c = good / (good + open_ + other) if good + open_ + other else 0.0
            if sum(score[i] >= 0.5 for i, _ in own) >= pii.MIN_SUPPORT and c >= pii.MIN_CONFIDENCE:
                conf[p] = c
        new = {}
        for q, i, _, _ in edges:
            if i not in seed and q in conf:
                new[i] = new.get(i, 1.0) * (1 - conf[q])
        score = {i: 1.0 if i in seed else 1 - new[i] if i in new else 0.0 for i in score}
    return {i: s for i, s in score.items() if i not in seed and s > 0}


def test_scores_match_brute_force(spark):
    rng = random.Random(5)
    edges = {}
    for p in range(12):
        for i in range(14):
            if rng.random() < 0.5:
                edges[p, f"i{i}"] = (p, f"i{i}", i < 12, rng.randint(1, 4))
    edges = list(edges.values())
    total = {p: sum(n for q, _, _, n in edges if q == p) + (p % 3 == 2) for p in range(12)}
    got = pii.score(spark.createDataFrame(edges, "pattern long, inst string, seed boolean, n long"),
                    spark.createDataFrame(list(total.items()), "pattern long, n long"))
    got = {r.inst: r.score for r in got.collect()}
    want = score_brute(edges, total, pii.ITERATIONS)
    assert want and got == pytest.approx(want, abs=1e-9)


def test_pattern_totals_count_every_place(spark):
    docs = [(1, "call me at x now", "", "", 1), (2, "me at me at me at", "", "", 1),
            (3, None, "", "", 1)]
    h = hashing.word_hashes(np.frombuffer(b"me at", np.uint8), np.array([0, 3]), np.array([2, 5]), True)
    p = int(hashing.windows(h, (0, 1), 1)[0].view(np.int64))
    df = spark.createDataFrame([(p,), (12345,)], "pattern long")
    got = pii.occurrences(spark.createDataFrame(docs, DOCS), df).collect()
    assert [(r.pattern, r.n) for r in got] == [(p, 3)]
