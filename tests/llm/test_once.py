"""What the operators on repeats do once: scans, counting, cutting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from rankfold.llm import bits, repeats, suffix
from tests.llm.test_pairs import frame


def test_texts_are_scanned_three_times(spark):
    seen = spark.sparkContext.accumulator(0)

    def scan(data, off):
        seen.add(1)
        return suffix._Runs(data, off)
    rng = random.Random(3)
    shared = "".join(rng.choice("abcd") for _ in range(70))
    docs = frame(spark, [f"{i:09d}{shared}{i * 7:09d}" for i in range(6)]).coalesce(1)
    cuts = repeats.repeated(repeats.identified(docs), scan, suffix.WINDOW, suffix.ORDER,
                            suffix._resolve)
    assert cuts.count() == 5  # all but the first
    assert seen.value == 3


def test_often_is_the_filter_of_anchors_that_occur_twice(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab ") for _ in range(n)) for n in (0, 20, 300, 300, 4000)]
    texts.append(texts[2])
    keys = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        keys.extend(suffix._Runs(raw, np.array([0, len(raw)])).key.tolist())
    twice = sorted(k for k, n in Counter(keys).items() if n > 1)
    want = np.zeros(1 << (bits.FILTER_BITS - 6), np.uint64)
    for k in twice:
        at = k >> (64 - bits.FILTER_BITS)
        want[at >> 6] |= np.uint64(1 << (at & 63))
    got = bits.gathered(repeats.often(frame(spark, texts).repartition(3), suffix._Runs))
    assert twice and (got == want).all()


def test_cut_against_plain_slices():
    rng = random.Random(5)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 30, 30, 0, 200)]
    cuts = [None, [(0, 1)], [(0, 4), (2, 9), (9, 30)], [(0, 5), (25, 30)], [], [
        (a, a + 9) for a in (rng.randrange(190) for _ in range(12))]]
    off = np.cumsum([0, *map(len, texts)])
    spans = pa.array([None if c is None else [{"a": a, "b": b} for a, b in c] for c in cuts],
                     pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    got = suffix._cut(pa.array(range(6), pa.int64()), np.frombuffer(b"".join(texts), np.uint8),
                      off, spans).to_pylist()
    for row, text, cut in zip(got, texts, cuts):
        gone = {i for a, b in cut or [] for i in range(a, b)}
        kept = bytes(c for i, c in enumerate(text) if i not in gone)
        assert row["kept"] == kept and row["n_bytes"] == len(text)
        assert row["n_removed"] == len(gone)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        heads = [i for i in sorted(gone) if i - 1 not in gone]
        assert [s["a"] for s in row["spans"]] == heads and row["n_spans"] == len(heads)
