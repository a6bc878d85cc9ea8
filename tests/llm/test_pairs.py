"""Near copies, repeats and benchmark overlaps against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rankfold.llm import hashing, minmax, recompress, spaced, suffix
from rankfold.llm.components import components
from tests.llm.conftest import DOCS, PASSAGE, all_rows, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)


# ---------------------------------------------------------------- hashing
def test_word_hashes_agree_with_words():
    texts = [r[1] for r in rows()] + ["A b", " lead", "trail ", "ÄÖ x", " wide "]
    column = pa.array(texts, pa.string())
    seen = {}
    for limit in (1, 64, 1 << 20):
        got = []
        for lo, hi, data, off in hashing.slices(column, limit):
            s, e, first = hashing.word_spans(data, off)
            h = hashing.word_hashes(data, s, e, True)
            raw = data.tobytes()
            for a, b in zip(first[:-1], first[1:]):
                got.append([raw[x:y].decode() for x, y in zip(s[a:b], e[a:b])])
                for w, v in zip(got[-1], h[a:b].tolist()):
                    assert seen.setdefault(lower(w), v) == v
        assert got == [WORD.findall(t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    edges += [(300 - i, 300 - i - 1) for i in range(30)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(21))
    assert all(got[i] == 100 for i in range(100, 160))
    assert all(got[i] == 270 for i in range(270, 301))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- near copies
def shingles(t):
    w = WORD.findall(lower(t or ""))
    if len(w) >= 5:
        return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def classes_brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if sets[a] and 100 * n >= 85 * len(sets[a] | sets[b]) and n:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets.items())


def near_copies(seed, n=260, words=120):
    """A large group of near copies on both sides of the threshold, chains, and others."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(words)] = f"x{rng.randint(0, 9)}"
        out.append(" ".join(w))
    w = list(base)
    for k in range(12):
        w = w[2:] + [f"chain{k}", f"chain{k}b"]
        out.append(" ".join(w).upper() if k % 2 else " ".join(w))
    out += [" ".join(f"o{rng.randint(0, 99999)}" for _ in range(rng.randint(0, 40)))
            for _ in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [256, 16])
def test_near_copies_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minmax, "BLOCK", block)
    texts = near_copies(11)
    got = all_rows(minmax.classes(frame(spark, texts).repartition(6)))
    want = classes_brute(list(enumerate(texts)))
    assert got == sorted(want, key=repr)
    kept = minmax.keep_one(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, k in want if k]


def test_pipeline_links_near_copies_from_080(spark):
    base = [f"w{k}" for k in range(95)]
    near = ["x" if k in (20, 60) else w for k, w in enumerate(base)]
    far = ["y" if k in (10, 30, 60) else w for k, w in enumerate(base)]
    texts = [" ".join(w) for w in (base, near, far)]
    a, b, c = map(shingles, texts)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85 and len(a & c) / len(a | c) < 0.80
    assert len(b & c) / len(b | c) < 0.80
    d = frame(spark, texts)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, d, "").collect()) == [0, 2]
    assert sorted(r.doc_id for r in minmax.keep_one(d).collect()) == [0, 1, 2]


def test_unique_text_stays_when_its_id_has_a_copy_too(spark):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "ab"]
    docs = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[0].upper())]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    assert sorted((r.doc_id, r.text) for r in minmax.keep_one(d).collect()) == [
        (1, texts[0]), (2, texts[1])]


def test_forest_matches_pairwise_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[:rng.integers(85, 101)],
                                      rng.integers(0, 1 << 62, rng.integers(0, 9), dtype=np.uint64)]))
            for _ in range(60)]
    for left in (60, 20):
        root = list(range(60))

        def top(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in itertools.combinations(range(60), 2):
            if min(a, b) < left and minmax.linked(sets[a], sets[b]):
                root[top(b)] = top(a)
        links = minmax.forest(list(range(60)), sets, left)
        got = list(range(60))

        def find(v):
            while got[v] != v:
                v = got[v]
            return v
        for a, b in links:
            assert minmax.linked(sets[a], sets[b])
            got[find(b)] = find(a)
        assert len(links) < 60
        for a, b in itertools.combinations(range(60), 2):
            assert (top(a) == top(b)) == (find(a) == find(b))


def test_minima_and_maxima_estimate_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = minmax.signature(x[:2500]), minmax.signature(x[500:])
    assert len(a) == 2 * minmax.PERMUTATIONS
    assert abs((a == b).mean() - 2000 / 3000) < 0.2


def test_near_copy_edges(spark, edge_docs, clash_docs, no_docs):
    got = all_rows(minmax.classes(edge_docs))
    assert got == all_rows(minmax.classes(clash_docs))
    by = {}
    for doc, n, comp, kept in got:
        by.setdefault(doc, []).append((n, comp, kept))
    for r in rows():
        assert len(shingles(r[1])) in [x[0] for x in by[r[0]]]
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert by[7] == [(1, 6, False)] and by[9][0][1:] == (8, False)
    assert by[12] == [(2, 12, True)] * 2
    assert sorted(by[None]) == [(0, None, True), (2, None, True)]
    assert minmax.classes(no_docs).count() == 0
    kept = minmax.keep_one(clash_docs)
    assert kept.columns == clash_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        d for d, _, _, k in got if k)


# ---------------------------------------------------------------- repeats
def repeating(seed, n=40):
    rng = random.Random(seed)
    pool = [" ".join(f"v{rng.randint(0, 60)}" for _ in range(rng.randint(15, 60)))
            for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.5 else
                 " ".join(f"v{rng.randint(0, 60)}" for _ in range(rng.randint(0, 30)))
                 for _ in range(rng.randint(0, 5))]
        sep = rng.choice([" ", "\n", "  "])
        out.append(sep.join(parts))
    return out + ["ab " * 100, "ab " * 90, "a" * 300, "a" * 120, "x y " * 60, "x y x " * 50,
                  "é" * 80, "é" * 90 + "z"]


def words_brute(docs):
    """docs: (id order key, id, text); the first place of a window is the least (key, start)."""
    ws = [(k, i, WORD.findall(t or "")) for k, i, t in docs]
    first = {}
    for k, _, w in ws:
        for p in range(len(w) - 19):
            x = tuple(w[p:p + 20])
            first[x] = min(first.get(x, (k, p)), (k, p))
    out = []
    for k, i, w in ws:
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if first[tuple(w[p:p + 20])] < (k, p):
                gone[p:p + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def bytes_brute(docs):
    first = {}
    for k, _, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], k), k)
    out = []
    for k, i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < k:
                gone[p:p + 50] = b"\x01" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_words_match_brute_force(spark, seed):
    texts = repeating(seed) + near_copies(seed, 12, 60)
    got = recompress.remove_repeats(frame(spark, texts).repartition(5)).drop("kept", "spans")
    assert all_rows(got) == words_brute([(i, i, t) for i, t in enumerate(texts)])


@pytest.mark.parametrize("split,chunk", [(20_000, 8 << 20), (2, 200)])
def test_repeated_bytes_match_brute_force(spark, monkeypatch, split, chunk):
    monkeypatch.setattr(suffix, "SPLIT", split)
    monkeypatch.setattr(suffix, "CHUNK_BYTES", chunk)
    texts = repeating(3) + near_copies(4, 12, 40)
    got = suffix.remove_repeats(frame(spark, texts).repartition(5)).drop("kept", "spans")
    assert all_rows(got) == bytes_brute([(i, i, t) for i, t in enumerate(texts)])


def test_repeat_edges(spark, edge_docs, clash_docs, no_docs):
    none = 2 ** 63 - 1
    docs = [(none if r[0] is None else r[0], r[0], r[1]) for r in rows()]
    words = recompress.remove_repeats(edge_docs).drop("kept", "spans")
    assert all_rows(words) == words_brute(docs)
    assert all_rows(recompress.remove_repeats(clash_docs).drop("kept", "spans")) == all_rows(words)
    raw = suffix.remove_repeats(edge_docs).drop("kept", "spans")
    assert all_rows(raw) == bytes_brute(docs)
    assert all_rows(suffix.remove_repeats(clash_docs).drop("kept", "spans")) == all_rows(raw)
    assert recompress.remove_repeats(no_docs).count() == 0
    assert suffix.remove_repeats(no_docs).count() == 0


def test_windows_have_interior_symbols():
    """Equal windows get equal anchors, and most windows hold a symbol of several words."""
    rng = random.Random(9)
    window = [f"q{rng.randint(0, 400)}" for _ in range(20)]
    keys, wide, total = set(), 0, 0
    for _ in range(200):
        pad = [f"q{rng.randint(0, 400)}" for _ in range(rng.randint(0, 30))]
        t = " ".join(pad + window + pad[::-1]).encode()
        data, off = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        r = recompress._Runs(data, off)
        k = int(np.searchsorted(r.start, len(pad), "right")) - 1
        keys.add(int(r.key[k]))
        s, e, first = hashing.word_spans(data, off)
        h = hashing.word_hashes(data, s, e)
        rounds = recompress.parse(h, np.zeros(len(h), np.int64), first)
        for at in range(len(h) - 19):
            total += 1
            wide += any(lo[i] >= at and hi[i] <= at + 20 and name[i] != h[word[i]]
                        for name, word, lo, hi in rounds for i in range(len(name)))
    assert len(keys) == 1
    assert wide > 0.95 * total


def test_induced_sorting_matches_plain_sorting():
    rng = random.Random(1)
    for trial in range(150):
        n = rng.randint(1, 400)
        base = [rng.randint(1, rng.choice([1, 2, 3, 256])) for _ in range(n)]
        if trial % 3 == 0:
            base = (base[:max(1, n // 5)] * 6)[:n]
        text = np.array(base + [0], np.uint16)
        places, common = suffix.induced_sort(text, 257, rng.choice([0, 100, 1 << 20]))
        assert sorted(places.tolist()) == list(range(len(text)))
        heads = [tuple(text[i:i + suffix.WINDOW]) for i in places]
        assert heads == sorted(heads)
        for i in range(1, len(places)):
            a, b = text[places[i - 1]:], text[places[i]:]
            m = min(len(a), len(b), suffix.WINDOW)
            differ = np.flatnonzero(a[:m] != b[:m])
            assert common[i] == (differ[0] if len(differ) else m)


# ---------------------------------------------------------------- benchmark overlaps
def overlap_brute(text, item):
    a, b = WORD.findall(lower(text or "")), WORD.findall(lower(item or ""))
    if len(b) <= 2:
        return bool(b) and a == b
    if len(b) < spaced.WINDOW:
        return any(sum(x != y for x, y in zip(a[i:], b)) <= (len(b) >= 8)
                   for i in range(len(a) - len(b) + 1))
    need = spaced.WINDOW - spaced.SUBSTITUTIONS
    return any(sum(x == y for x, y in zip(a[i:i + 13], b[j:j + 13])) >= need
               for i in range(len(a) - 12) for j in range(len(b) - 12))


def test_masks_hit_every_window_with_two_substitutions():
    for gone in itertools.combinations(range(spaced.WINDOW), spaced.SUBSTITUTIONS):
        assert any(not any(i + k in gone for k in spaced.care(m))
                   for m in spaced.MASKS for i in range(spaced.WINDOW - len(m) + 1)), gone


@pytest.mark.parametrize("part_words", [spaced.PART_WORDS, 60])
def test_overlaps_match_brute_force(spark, part_words):
    rng = random.Random(4)
    items = [" ".join(f"b{rng.randint(0, 30)}" for _ in range(n))
             for n in [1, 2, 3, 4, 5, 7, 7, 8, 8, 9, 11, 12, 12, 13, 13, 14, 25, 25, 25, 40, 40]] + [None, "", PASSAGE]
    texts = []
    for _ in range(120):
        w = [f"b{rng.randint(0, 30)}" for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.7:
            b = (rng.choice(items) or "").split()
            a = rng.randint(0, max(0, len(b) - 13))
            b = b[a:a + rng.randint(8, 30)]
            if len(b) <= 2:
                w = w[:rng.randint(0, 1)]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                if b:
                    b[rng.randrange(len(b))] = "sub"
            w[len(w) // 2:len(w) // 2] = [x.upper() for x in b]
        texts.append(" ".join(w))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in spaced.contaminated(
        frame(spark, texts), bench, part_words).collect()}
    want = {(i, j) for i, t in enumerate(texts) for j, b in enumerate(items) if overlap_brute(t, b)}
    assert got == want and len(want) > 20
    kept = spaced.keep_clean(frame(spark, texts), bench, part_words)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        set(range(len(texts))) - {i for i, _ in want})


@pytest.mark.parametrize("n,changed,found", [
    (1, 0, False), (2, 0, False), (3, 0, True), (3, 1, False), (7, 0, True), (7, 1, False),
    (8, 0, True), (8, 1, True), (8, 2, False), (12, 1, True), (12, 2, False), (13, 2, True),
    (13, 3, False)])
def test_short_items(spark, n, changed, found):
    """Every place of the changed words, inside a longer document."""
    item = [f"w{i}" for i in range(n)]
    texts = []
    for gone in itertools.combinations(range(n), changed):
        w = ["x" if i in gone else c for i, c in enumerate(item)]
        texts.append(" ".join(["before", "it", *w, "after"]))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = spaced.contaminated(frame(spark, texts), bench)
    assert got.count() == (len(texts) if found else 0)
    whole = spaced.contaminated(frame(spark, [" ".join(item)]), bench).collect()
    assert [(r.n_spans, r.n_words, r.n_equal) for r in whole] == [(1, n, n)]


def test_repeated_rows_and_shared_ids(spark):
    docs = spark.createDataFrame(
        [(1, PASSAGE), (1, PASSAGE), (1, "another text under the same number"), (None, PASSAGE),
         (None, "nothing here"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, PASSAGE), (7, PASSAGE), (None, PASSAGE), (-1, PASSAGE),
                                   (-1, "another text under the same number")],
                                  "item_id long, text string")
    n = len(PASSAGE.split())
    want = [(d, i, 1, n, n) for d in (1, None) for i in (7, None, -1)] + [(1, -1, 1, 6, 6)]
    assert all_rows(spaced.contaminated(docs, bench)) == sorted(want, key=repr)
    assert all_rows(spaced.keep_clean(docs, bench)) == [(None, "nothing here"), (None, None)]


def test_overlap_edges(spark, edge_docs, clash_docs, no_docs):
    bench = spark.createDataFrame([(7, PASSAGE), (7, PASSAGE), (8, None), (None, "short one")],
                                  "item_id long, text string")
    got = all_rows(spaced.contaminated(edge_docs, bench))
    assert [(r[0], r[1]) for r in got] == [(1, 7), (2, 7)]
    assert got == all_rows(spaced.contaminated(clash_docs, bench))
    kept = spaced.keep_clean(clash_docs, bench)
    assert kept.columns == clash_docs.columns and kept.count() == len(rows()) - 2
    assert spaced.contaminated(no_docs, bench).count() == 0
    none = bench.filter("item_id > 100")
    assert spaced.contaminated(edge_docs, none).count() == 0
    assert spaced.keep_clean(edge_docs, none).count() == len(rows())


def test_a_worker_hands_back_what_a_task_took():
    """Blocks below the size that the allocator maps one by one stay with a process otherwise."""
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096
    hashing.hand_back()
    before = resident()
    held = [np.ones(12_000) for _ in range(1500)]  # 144 MB in blocks of 96 kB
    pin = np.ones(12_000)
    del held
    hashing.hand_back()
    assert resident() - before < 40e6 and len(pin)
