"""Byte-level BPE against the public library, and its round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from rankfold.llm import bpe
from tests.llm.conftest import all_rows, rows

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def raw():
    with open(RANKS, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(raw):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(raw),
                             special_tokens={})


ODD = ["", " ", "\n\n  x", "a\x00b \x1c\x1d c　d", "don't we'll I'VE 's's",
       "café naïve \U0001f600\U0001f468‍\U0001f469", "a" * 5000, "ab" * 3000,
       "\x85\xa0  x", "1234567 ½² ١٢", "中文字符 " * 50,
       "<|endoftext|> ordinary", "́é ﻿", "-" * 300 + " " * 300 + "\t" * 9,
       "ᲀ Ⱟ \U00010ec2"]


def test_ids_equal_the_librarys(raw, library):
    rng = random.Random(2)
    alphabets = ["abcde ", "aA1 '\n.s", "äöüße st", "中文a ",
                 "".join(map(chr, range(1, 256))), "the of and ing"]
    texts = ODD + ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(0, 300)))
                   for _ in range(600)]
    v = bpe.Vocabulary(bpe.read_ranks(raw), P.PATTERN)
    for part in (texts, texts[::-1]):  # the second time from known words
        for text, ids in zip(part, v.encode(part)):
            assert ids.tolist() == library.encode_ordinary(text), text[:60]
            assert b"".join(v.tokens[i] for i in ids) == text.encode()


def test_any_ranks_take_the_lowest_first():
    """Ranks in random order, where a merge may make a pair of a lower rank."""
    rng = random.Random(7)
    for trial in range(60):
        order = [bytes([b]) for b in range(256)]
        more = {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(25)}
        tail = sorted(more)
        rng.shuffle(tail)
        ranks = {t: i for i, t in enumerate(order + tail)}
        lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        v = bpe.Vocabulary(ranks, P.PATTERN)
        words = ["".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(30)]
        for text, ids in zip(words, v.encode(words)):
            assert ids.tolist() == lib.encode_ordinary(text), (trial, text)


def test_a_full_list_of_known_words_changes_nothing(raw, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHE_LETTERS", 4)
    v = bpe.Vocabulary(bpe.read_ranks(raw), P.PATTERN)
    for text in ODD * 2:
        assert v.encode([text])[0].tolist() == library.encode_ordinary(text)
        assert all(len(w) <= 4 for w in v.words)


def expected(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_edges_clashes_and_empty_tables(spark, library, edge_docs, clash_docs, no_docs):
    want = sorted((expected(library, r[0], r[1]) for r in rows()), key=repr)
    assert all_rows(bpe.digests(edge_docs)) == want
    assert all_rows(bpe.digests(clash_docs)) == want
    assert bpe.digests(no_docs).count() == 0
    assert bpe.encode(no_docs).count() == 0 and bpe.decode(bpe.encode(no_docs)).count() == 0


def test_encode_and_decode_round_trip(spark, library, edge_docs):
    tokens = bpe.encode(edge_docs)
    got = sorted(((r.doc_id, r.ids) for r in tokens.collect()), key=repr)
    assert got == sorted(((r[0], library.encode_ordinary(r[1] or "")) for r in rows()), key=repr)
    back = sorted(((r.doc_id, bytes(r.raw)) for r in bpe.decode(tokens).collect()), key=repr)
    assert back == sorted(((r[0], (r[1] or "").encode()) for r in rows()), key=repr)


def test_whole_table_equals_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((expected(library, r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert all_rows(bpe.digests(docs)) == want


def test_rank_files_are_read_in_full(raw):
    ranks = bpe.read_ranks(raw)
    assert len(ranks) == raw.count(b"\n") and ranks[base64.b64decode(raw.split()[0])] == 0
    assert np.all(np.sort(list(ranks.values())) == np.arange(len(ranks)))
