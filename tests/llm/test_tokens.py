"""Token files against the tokenizer itself, block coding, and the pipeline."""

import os
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from rankfold.llm import minmax, mixing, quality, rans, spaced
from rankfold.session import ensure_checkpoint_dir
from tests.llm.conftest import DOCS, all_rows, rows
from tests.llm.test_native import base
from tests.llm.test_pairs import classes_brute, overlap_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(rans.default_tokenizer())


def brute(tokenizer, docs):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) in doc_id order."""
    out, at = [], 0
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [rans.END_ID]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_words_encode_as_the_tokenizer_does(tokenizer):
    import random
    rng = random.Random(1)
    parts = ["It's", "we'LL", "'s", "don", "'t", "A", "z", "Éa", "ß", "Straße", "ÿ", "12", "3", ".", "..",
             "'", "_", "<|", "|>", "<|endoftext|>", "$%", "ñ", "e\u0301", "\u00aa", "\u00b2", "Σ", "ΑΣ", "中文",
             "\U0001f600", "\u00a0", "\u3000", "-", "\x1c", "×"]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
             for _ in range(3000)]
    with open(rans.default_tokenizer(), encoding="utf-8") as f:
        definition = f.read()
    assert rans._drops_space(definition)
    got = rans.encode_texts(pa.array(texts), definition, "<u2")
    for t, ids in zip(texts, got):
        want = tokenizer.encode(t, add_special_tokens=False).ids + [rans.END_ID]
        assert np.frombuffer(ids, "<u2").tolist() == want, t


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    file = public_tokenizers.path("byte_bpe_50k.json")
    with open(file, encoding="utf-8") as f:
        definition = f.read()
    got = rans.encode_texts(pa.array(["Hello  big world", None]), definition, "<u2")
    want = Tokenizer.from_file(file).encode("Hello  big world", add_special_tokens=False).ids
    assert np.frombuffer(got[0], "<u2").tolist() == want + [rans.END_ID]


def path(spark):
    return f"{ensure_checkpoint_dir(spark)}/t-{uuid.uuid4().hex}"


def test_ids_of_a_batch_are_one_array_and_pieces_are_cut_as_by_the_expression():
    """Ids are counted a batch at a time; the order of the alternatives changes no piece."""
    column = pa.array([b"\x01\x00\x02\x00", b"", b"\x03\x00"], pa.binary())
    assert rans.joined_ids(column, "<u2").tolist() == [1, 2, 3]
    assert rans.joined_ids(column[1:], "<u2").tolist() == [3]
    assert rans.joined_ids(column[:0], "<u2").tolist() == []
    lower = rans._Pieces.LOWER
    by_contract = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{lower}]+|[0-9]|[^ \t-\r{lower}0-9]+").findall
    rnd = random.Random(1)
    for _ in range(5000):
        text = "".join(rnd.choices("'streveml d09.,-\t\n\u00e9\u00ff!ab''", k=rnd.randrange(25)))
        assert rans._Pieces.PIECES(text) == by_contract(text)
    own = rans._Pieces.__new__(rans._Pieces)
    for text in ("plain 'text\t", "\x00", "a\x7f", "caf\u00e9", "\u0142", "a <| b", ""):
        assert own._plain(text) == (
            "<|" not in text and rans._Pieces.PLAIN_TEXT(text) is not None), text


@pytest.mark.parametrize("block", [1 << 17, 700])
def test_files_round_trip(spark, tokenizer, monkeypatch, block):
    monkeypatch.setattr(rans, "BLOCK", block)
    docs = [(i, t) for i, t in enumerate(
        [r[1] for r in rows()] + ["It's we'll I'VE <|endoftext|> a<|startoftext|>b ΑΣ ΣΑΣ 12 ﬁ é"])]
    df = spark.createDataFrame([(i, t, "", "", 1) for i, t in docs], DOCS).repartition(4)
    got = [tuple(r) for r in rans.encode_corpus(df, path(spark)).orderBy("doc_id").collect()]
    assert got == brute(tokenizer, docs)


def test_files_with_ties_nulls_and_clashes(spark, tokenizer, edge_docs, clash_docs, no_docs):
    got = rans.encode_corpus(edge_docs, path(spark)).collect()
    want = [(r[0], *brute(tokenizer, [(r[0], r[1])])[0][2:]) for r in rows()]
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=repr) == sorted(
        want, key=repr)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got),
                                             key=lambda d: (d is not None, d or 0))
    assert all_rows(rans.encode_corpus(clash_docs, path(spark))) == sorted(
        map(tuple, got), key=repr)
    assert rans.encode_corpus(no_docs, path(spark)).count() == 0


def model(ids):
    c = np.bincount(ids)
    at = np.flatnonzero(c)
    f = np.maximum(1, c[at] * (1 << rans.SCALE) // c.sum())
    f[np.argmax(f)] += (1 << rans.SCALE) - f.sum()
    return rans.Model(at, f)


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 5000, 270000])
def test_blocks_decode_from_any_place(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 40000).astype(np.uint32)
    m = model(ids)
    payload, states, positions = rans.encode_block(ids, m)
    assert (rans.decode_block(n, payload, states, positions, m) == ids).all()
    assert len(positions) == -(-n // (rans.LANES * rans.CHECKPOINT))
    for a, b in [(0, 1), (n // 2, n // 2 + 7), (n - 1, n), (133000, 133005), (5, 5)]:
        if a < n:
            assert (rans.decode_block(n, payload, states, positions, m, a, b) == ids[a:b]).all()
    if n == 270000:
        p = np.bincount(ids)[1:] / n
        bits = -(p[p > 0] * np.log2(p[p > 0])).sum()
        assert 8 * len(payload) / n < bits * 1.02 + 0.2


def test_damage_is_found(spark):
    where = path(spark)
    df = spark.createDataFrame([(1, "some text to spoil " * 50, "", "", 1)], DOCS)
    rans.write(df, rans.default_tokenizer(), where)
    blocks = spark.read.parquet(f"{where}/blocks").withColumn("crc", F.col("crc") + 1)
    bad = path(spark)
    blocks.write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{where}/freqs").write.parquet(f"{bad}/freqs")
    with pytest.raises(Exception, match="checksum of block"):
        rans.read_documents(spark, bad).collect()


def test_joined_crc():
    a, b = os.urandom(1000), os.urandom(3_000_000)
    assert rans.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def fours(text):
    w = text.lower().split()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_pipeline_matches_brute_force(spark, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = [d for d in docs if (b := base(d[1]))[0] >= 50 and 100 * b[4] <= 50 * b[0]]
    # the labels are too few here to prove any cutoff, so the base rule acts alone
    assert all(not r.cuts for r in quality.cutoffs(
        quality.measured_documents(spark.read.parquet(f"{SF}/documents.parquet")),
        spark.read.parquet(f"{SF}/labels.parquet")).collect())
    one = {i for i, _, _, kept in classes_brute([(d[0], d[1]) for d in good]) if kept}
    # 13 words with 2 substitutions hold 4 equal ones in a row, so other pairs need no look
    runs = [fours(b) for b in items]
    clean = [d for d in good if d[0] in one and not any(
        overlap_brute(d[1], b) for b, r in zip(items, runs) if r & fours(d[1]))]
    assert len(docs) > len(good) > len(one) > len(clean) > 50
    got = corpus_pipeline.run(spark, SF).collect()
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= {d[0] for d in clean}
    alone = {d[0]: brute(tokenizer, [(d[0], d[1])])[0][2:] for d in clean}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, *alone[r.doc_id])
        at += r.n_tokens
    taken, size = defaultdict(int), defaultdict(int)
    target = {r.source: r.target for r in mixing.allocate(
        spark.createDataFrame(clean, DOCS)).collect()}
    for d in clean:
        size[d[3]] = max(size[d[3]], len(d[1].split()))
        taken[d[3]] += copies[d[0]] * len(d[1].split())
    for s, t in target.items():
        assert abs(taken[s] - t) <= size[s]


def test_quality_stage_with_active_cutoffs(spark, tmp_path):
    def text(i, symbols):
        return " ".join(f"w{i}q{k}" for k in range(60)) + " " + "#" * symbols
    docs = [(i, text(i, 0), "en", "s", 1) for i in range(875)]
    docs += [(i, text(i, 0), "en", "s", 1) for i in range(2000, 2010)]
    docs += [(i, text(i, 200), "en", "s", 1) for i in range(3000, 3010)]
    d = spark.createDataFrame(docs, DOCS)
    for n, want in ((875, set(range(875)) | set(range(2000, 2010))), (874, {x[0] for x in docs})):
        labels = [(i, 1, 0) for i in range(n)]
        path = tmp_path / str(n)
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
            str(path / "labels.parquet"))
        got = corpus_pipeline.quality_rules(spark, d, str(path))
        assert {r.doc_id for r in got.collect()} == want


def test_stages_keep_columns_and_take_edges(spark, clash_docs, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash_docs, str(tmp_path))
        assert out.columns == clash_docs.columns, name
        assert 0 < out.count(), name
        assert stage(spark, no_docs, str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontaminate", "source_mix", "token_files"]
    assert minmax.PERCENT >= 80 and spaced.WINDOW - spaced.SUBSTITUTIONS == 11
