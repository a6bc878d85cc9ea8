"""Byte-level BPE by replaying merges over many words at once.

A text is cut by the vocabulary's pattern and every match is encoded by itself.
Texts are taken in slices; the distinct words of a slice that are not known yet
are laid out one after the other, each byte a token.  An inverted index leads
from the token that a pair of neighbours merges into to the places of such pairs
in all the words.  The index is emptied in rank order: all places of the lowest
rank are merged, leftmost first, and each merge looks again at the two pairs it
touches and enters them.  A pair that comes to rank below the one in hand (which
trained ranks do not produce) sends what is left of the latter back, so that the
lowest rank of a word always goes first, whatever the ranks.  A match that is a
token as a whole is that token.

Words meet their ids again within the slice, so that nothing is shuffled, and the
words of a common list stay known to a task up to ``CACHE_WORDS``.  What a task
holds is bounded by the slice, the list and the longest text.

Defined results: a null text is empty and has no ids; repeated rows and rows
without an id are encoded row by row; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.session import ship_package

# Production parameters.
SLICE_BYTES = 2 << 20
CACHE_WORDS = 250_000
CACHE_LETTERS = 48

_KNOWN: dict[tuple[int, str], "Vocabulary"] = {}


class Vocabulary:
    """Ranks, the pairs that merge, and the words encoded lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.words = ranks, {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.width = max(1, len(self.tokens))
        # every way to put a token together from two
        self.pairs = {
            ranks[t[:i]] * self.width + ranks[t[i:]]: rank for t, rank in ranks.items()
            for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.first = np.full(1 << 16, -1, np.int64)
        for a in range(256):
            for b in range(256):
                self.first[a << 8 | b] = ranks.get(bytes([a, b]), -1)
        # \s is the Unicode property, which leaves out the control characters 28 to 31
        self.wide = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(
            r"\S", r"\P{White_Space}")).findall
        self.narrow = re.compile(_latin(pattern)).findall

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.wide(text)
        return self.narrow(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.pieces(t) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        new = list(set().union(*cut).difference(known))
        raw = [w.encode() for w in new]
        long = []
        for word, ids in zip(new, self.replay(raw)):
            known[word] = ids
            if len(word) > CACHE_LETTERS:
                long.append(word)
        out = [np.frombuffer(b"".join(map(known.__getitem__, p)), np.uint32) for p in cut]
        for word in long:
            del known[word]
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as 32-bit numbers, all words merged at once."""
        whole = [self.ranks.get(w) for w in words]
        open_ = [w for w, r in zip(words, whole) if r is None]
        done = iter(self._merged(open_))
        return [next(done) if r is None else array("I", (r,)).tobytes() for r in whole]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        right = np.arange(1, len(data) + 1)
        right[ends[ends > starts] - 1] = -1
        left = np.arange(-1, len(data) - 1)
        left[starts[ends > starts]] = -1
        rank = np.full(len(data), -1, np.int64)
        rank[:-1] = self.first[data[:-1].astype(np.int64) << 8 | data[1:]]
        at = np.flatnonzero((rank >= 0) & (right >= 0))
        at = at[np.argsort(rank[at], kind="stable")]
        kinds, first = np.unique(rank[at], return_index=True)
        index = {r: p.tolist() for r, p in zip(kinds.tolist(), np.split(at, first[1:]))}
        tok, right, left = self.bytes[data].tolist(), right.tolist(), left.tolist()
        heap, width, merges = list(index), self.width, self.pairs.get
        heapify(heap)
        while heap:
            r = heappop(heap)
            spots = sorted(index.pop(r))
            for k, p in enumerate(spots):
                q = right[p]
                if q < 0 or tok[p] < 0 or merges(tok[p] * width + tok[q]) != r:
                    continue  # one of the two has been merged meanwhile
                tok[p], tok[q] = r, -1
                z = right[p] = right[q]
                lowest = r
                if z >= 0:
                    left[z] = p
                    s = merges(r * width + tok[z])
                    if s is not None:
                        lowest = min(lowest, s)
                        if s in index:
                            index[s].append(p)
                        else:
                            index[s] = [p]
                            heappush(heap, s)
                o = left[p]
                if o >= 0:
                    s = merges(tok[o] * width + r)
                    if s is not None:
                        lowest = min(lowest, s)
                        if s in index:
                            index[s].append(o)
                        else:
                            index[s] = [o]
                            heappush(heap, s)
                if lowest < r:
                    if r not in index:
                        index[r] = []
                        heappush(heap, r)
                    index[r].extend(spots[k + 1:])
                    break
        tok = np.array(tok, np.int64)
        alive = tok >= 0
        cuts = np.concatenate([[0], np.cumsum(alive)])[ends].tolist()
        raw = tok[alive].astype(np.uint32).tobytes()
        return [raw[4 * a:4 * b] for a, b in zip([0, *cuts[:-1]], cuts)]


def _latin(pattern: str) -> str:
    """The pattern for texts of the first 256 characters, with classes spelt out."""
    def of(prop):
        return "".join(re.escape(chr(i)) for i in range(256) if regex.match(prop, chr(i)))
    letters, numbers, space = of(r"\p{L}"), of(r"\p{N}"), of(r"\p{White_Space}")

    def spelt(m):
        inner = m[0].startswith("[")
        body = (m[0][1:-1] if inner else m[0]).replace(r"\p{L}", letters).replace(
            r"\p{N}", numbers).replace(r"\s", space)
        return f"[^{space}]" if m[0] == r"\S" else f"[{body}]"
    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s|\\S", spelt, pattern)


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank per line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}


def vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    """One per worker and rank file."""
    key = hash(raw), pattern
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Vocabulary(read_ranks(raw), pattern)
    return _KNOWN[key]


def _slices(column: pa.Array):
    """(first row, texts) of slices of a text column."""
    for lo, _, data, off in hashing.slices(column, SLICE_BYTES):
        raw, off = data.tobytes(), off.tolist()
        yield lo, [raw[a:b].decode() for a, b in zip(off[:-1], off[1:])]


def _broadcast(docs: DataFrame, ranks_path: str):
    ship_package(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None
           ) -> DataFrame:
    """One row per document row: ``doc_id`` and ``ids``, an array of int."""
    ranks, pattern = _broadcast(docs, ranks_path or default_ranks()), pattern or default_pattern()

    def ids(batches):
        for b in batches:
            v = vocabulary(ranks.value, pattern)
            for lo, texts in _slices(b.column(1)):
                got = v.encode(texts)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(texts)), pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()),
                        pa.array(np.concatenate(got).astype(np.int32)))], names=["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        ids, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """One row per row of ``doc_id, ids``: ``doc_id`` and ``raw``, the bytes of the ids."""
    ranks, pattern = _broadcast(tokens, ranks_path or default_ranks()), default_pattern()

    def back(batches):
        for b in batches:
            t = vocabulary(ranks.value, pattern).tokens
            raw = [b"".join(map(t.__getitem__, x or ())) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())],
                                             names=["doc_id", "raw"])
    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        back, "doc_id long, raw binary")


def digests(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None
            ) -> DataFrame:
    """One row per document row: number and hash of its ids, hash of the ids decoded."""
    ranks, pattern = _broadcast(docs, ranks_path or default_ranks()), pattern or default_pattern()

    def both(batches):
        for b in batches:
            v = vocabulary(ranks.value, pattern)
            decimal, tokens = v.decimal.__getitem__, v.tokens.__getitem__
            for lo, texts in _slices(b.column(1)):
                n, told, back = [], [], []
                for ids in v.encode(texts):
                    ids = ids.tolist()
                    n.append(len(ids))
                    told.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join(map(tokens, ids))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(texts)), pa.array(n, pa.int64()), pa.array(told),
                     pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
