"""Token ids as files of range-coded blocks (static rANS).

Format, a folder of two Parquet tables:

* ``freqs`` (id, freq): the shared frequency table; frequencies sum to
  ``2 ** SCALE`` and every id that occurs has at least 1.
* ``blocks``: one row per block of up to ``BLOCK`` tokens, decodable by itself.
  ``part`` and ``block`` order the blocks, ``first`` is the block's first token
  within its part, ``n`` its tokens.  Token ``k`` belongs to lane ``k mod
  LANES``; all lanes share the 32-bit words of ``payload``, those of one step
  in lane order.  ``states`` holds the 64-bit lane states before every
  ``CHECKPOINT``-th step and ``positions`` the words read by then, so decoding
  can start at any of them; the first is the start.  ``crc`` is the CRC-32 of
  the block's ids as little-endian 32-bit integers.  ``docs`` lists the
  documents, or pieces of a document longer than the rest of a block.

Parts follow each other in ascending ``doc_id`` order (nulls first, ties by a
hash of the tokens).

Defined results: null and blank texts have the end id alone; a repeated
document row is written and returned as often as it occurs; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.text import discard, release, written_table
from rankfold.session import ship_package

# Production parameters.
END_ID = 1
SCALE = 20
LANES = 1024
CHECKPOINT = 128
BLOCK = 1 << 18
CACHE_PIECES = 300_000
# Fixed value: the word expression of the tokenizers that ``_Pieces`` knows.
WORD_PATTERN = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")

LOW = np.uint64(1 << 31)
U = np.uint64
BLOCKS = ("part int, block long, first long, n long, payload binary, states binary, "
          "positions array<long>, crc long, docs array<struct<seq:long,doc_id:long,n:long,"
          "start:long,piece:int,pieces:int>>")
PIECES = "part int, seq long, doc_id long, start long, n long, piece int, pieces int, crc long"

_TOKENIZERS: dict[int, "_Pieces | _Texts"] = {}


# ---------------------------------------------------------------- tokens
class _Texts:
    """Encodes whole texts, whatever the tokenizer."""

    def __init__(self, tok, code: str):
        self.tok, self.code = tok, code

    def encode(self, texts: list[bytes]) -> list[bytes]:
        got = self.tok.encode_batch([t.decode() for t in texts], add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in got]


class _Pieces(dict):
    """Encodes piece by piece, each distinct piece of a slice once; a map from piece to ids.

    For tokenizers that lower-case, drop white space and cut at an expression of their own,
    so that a text's ids are those of its pieces in turn.  Texts of ASCII and Latin-1 letters
    only, which the normaliser just lower-cases, are cut here and their pieces given to the
    tokenizer's model; the words of other texts that are not of this kind go through the
    whole tokenizer.  Up to ``CACHE_PIECES`` pieces stay known to a task.
    """

    LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    LOWER = "a-z\u00df-\u00f6\u00f8-\u00ff"
    PLAIN_WORD = re.compile(f"[!-~{LETTERS}]+").fullmatch
    PLAIN_TEXT = re.compile(f"[ \t-\r!-~{LETTERS}]*").fullmatch
    PLAIN_ASCII = bytes([*range(9, 14), *range(32, 127)])
    # letters first: no other alternative begins with one
    PIECES = re.compile(f"[{LOWER}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \t-\r{LOWER}0-9]+").findall

    def __init__(self, tok, code: str):
        super().__init__()
        self.tok, self.code, self.tokenize = tok, code, tok.model.tokenize
        # the letters of the byte-level alphabet, as the tokenizer's own step writes them
        from tokenizers.pre_tokenizers import ByteLevel
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0]
                      for c in [*range(33, 127), *range(0xC0, 0x100)]}

    def _plain(self, text: str) -> bool:
        if "<|" in text:
            return False
        if text.isascii():
            return not text.encode().translate(None, self.PLAIN_ASCII)
        return self.PLAIN_TEXT(text) is not None

    def _words(self, text: str) -> bytes:
        """Ids of a text with words that only the whole tokenizer knows to treat."""
        out, run = [], []

        def flush():
            out.append(self._joined(self.PIECES(" ".join(run).lower())))
            run.clear()
        for raw in text.encode().split():
            word = raw.decode()
            if "<|" not in word and self.PLAIN_WORD(word):
                run.append(word)
            else:
                flush()
                out.append(array(self.code, self.tok.encode(
                    word, add_special_tokens=False).ids).tobytes())
        flush()
        return b"".join(out)

    def _joined(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def __missing__(self, piece: str) -> bytes:
        ids = array(self.code, [t.id for t in self.tokenize(
            piece if piece.isascii() else piece.translate(self.bytes))]).tobytes()
        self[piece] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > CACHE_PIECES:
            self.clear()
        texts = map(bytes.decode, texts)
        return [self._joined(self.PIECES(t.lower())) if self._plain(t) else self._words(t)
                for t in texts]


def _drops_space(definition: str) -> bool:
    """Whether the tokenizer lower-cases, drops white space and splits as ``_Pieces`` does."""
    d = json.loads(definition)
    norm = [n["type"] for n in (d["normalizer"] or {}).get("normalizers", [])]
    pre = (d["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (norm == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == [
        "Split", "ByteLevel"] and pre[0]["invert"] and pre[0]["behavior"] == "Removed"
        and pre[0]["pattern"] == {"Regex": WORD_PATTERN} and not pre[1]["use_regex"]
        and not pre[1]["add_prefix_space"] and not d["post_processor"])


def encode_texts(column: pa.Array, definition: str, width: str) -> list[bytes]:
    """Ids of each text and the end id, as bytes of ``width`` (a numpy type)."""
    key = hash((definition, width))
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        kind = _Pieces if _drops_space(definition) else _Texts
        _TOKENIZERS[key] = kind(Tokenizer.from_str(definition), "H" if width == "<u2" else "I")
    end = np.array([END_ID], width).tobytes()
    out = []
    for _, _, data, off in hashing.slices(column):
        raw = data.tobytes()
        got = _TOKENIZERS[key].encode(
            [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())])
        out.extend(ids + end for ids in got)
    return out


def token_table(docs: DataFrame, tokenizer_path: str) -> tuple[DataFrame, str]:
    """Written table (doc_id, ids, tie) and the width of an id in ``ids``."""
    from tokenizers import Tokenizer
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    width = "<u2" if Tokenizer.from_str(text).get_vocab_size() <= 1 << 16 else "<u4"
    definition = docs.sparkSession.sparkContext.broadcast(text)

    def encode(batches):
        for b in batches:
            if b.num_rows:
                ids = encode_texts(b.column(1), definition.value, width)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        hashing.hand_back()
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, ids binary")
    return written_table(tokens.withColumn("tie", F.xxhash64("ids")), "tokens"), width


# ---------------------------------------------------------------- frequencies
def joined_ids(column: pa.Array, width: str) -> np.ndarray:
    """The ids of all rows of a column of ``ids``, one after the other."""
    _, where, data = column.buffers()
    off = np.frombuffer(where, np.int32)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, width)
    return np.frombuffer(memoryview(data)[off[0]:off[-1]], width)


def frequencies(tokens: DataFrame, width: str) -> DataFrame:
    """(id, freq), with frequencies proportional to counts that sum to ``2 ** SCALE``."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            c = np.bincount(joined_ids(b.column(0), width))
            if len(c) > len(total):
                total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
            total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "c"])
    counts = (tokens.select("ids").mapInArrow(count, "id long, c long")
              .groupBy("id").agg(F.sum("c").alias("c")))
    # one row per id of the vocabulary
    got = counts.orderBy("id").toArrow()
    ids, c = got["id"].to_numpy(), got["c"].to_numpy().astype(np.float64)
    if len(ids) > 1 << (SCALE - 1):
        raise ValueError("the vocabulary is too large for the frequency scale")
    freq = np.maximum(1, np.floor(c / max(c.sum(), 1) * (1 << SCALE))).astype(np.int64)
    spare = (1 << SCALE) - int(freq.sum())
    while len(freq) and spare:
        # what rounding left over or took too much, from or to the largest
        k = int(np.argmax(freq))
        step = spare if spare > 0 else max(spare, -(int(freq[k]) // 2))
        freq[k] += step
        spare -= step
    return tokens.sparkSession.createDataFrame(
        pa.table({"id": pa.array(ids, pa.int64()), "freq": pa.array(freq, pa.int64())}),
        "id long, freq long")


class Model:
    """Frequency tables of the coder, indexed by id and by slot."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        size = int(ids.max()) + 1 if len(ids) else 0
        self.freq, self.low = np.zeros(size, U), np.zeros(size, U)
        self.freq[ids] = freq.astype(U)
        self.low[ids] = (np.cumsum(freq) - freq).astype(U)
        self.symbol = np.repeat(ids, freq).astype(np.uint32)


def encode_block(ids: np.ndarray, m: Model) -> tuple[bytes, bytes, list[int]]:
    """(payload, states, positions) of a block's ids."""
    steps = -(-len(ids) // LANES)
    x = np.full(LANES, LOW, U)
    words, marks, written = [], [], 0
    for k in range(steps - 1, -1, -1):
        s = ids[k * LANES:(k + 1) * LANES]
        f = m.freq[s]
        y = x[:len(s)]
        over = y >= f << U(63 - SCALE)
        w = y[over].astype(np.uint32)
        y = np.where(over, y >> U(32), y)
        words.append(w)
        written += len(w)
        q = y // f
        x[:len(s)] = (q << U(SCALE)) + (y - q * f) + m.low[s]
        if k % CHECKPOINT == 0:
            marks.append((x.copy(), written))
    marks.reverse()
    payload = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    states = np.concatenate([a for a, _ in marks]) if marks else np.empty(0, U)
    return (payload.astype("<u4").tobytes(), states.astype("<u8").tobytes(),
            [written - w for _, w in marks])


def decode_block(n: int, payload: bytes, states: bytes, positions: list[int], m: Model,
                 start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, from the last checkpoint before ``start``."""
    stop = n if stop is None else min(stop, n)
    mark = start // (LANES * CHECKPOINT)
    if start >= stop:
        return np.empty(0, np.uint32)
    words = np.frombuffer(payload, "<u4").astype(U)
    x = np.frombuffer(states, "<u8").reshape(-1, LANES)[mark].astype(U)
    at = positions[mark]
    first = mark * CHECKPOINT
    out = []
    for k in range(first, -(-stop // LANES)):
        lanes = min(LANES, n - k * LANES)
        slot = x[:lanes] & U((1 << SCALE) - 1)
        s = m.symbol[slot]
        y = m.freq[s] * (x[:lanes] >> U(SCALE)) + slot - m.low[s]
        need = np.flatnonzero(y < LOW)
        y[need] = (y[need] << U(32)) | words[at:at + len(need)]
        at += len(need)
        x[:lanes] = y
        out.append(s)
    ids = np.concatenate(out)
    return ids[start - first * LANES:stop - first * LANES]


# ---------------------------------------------------------------- files
def write(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Tokenise ``docs`` and write the blocks and frequency table below ``path``."""
    spark = docs.sparkSession
    tokens, width = token_table(docs, tokenizer_path)
    freqs = frequencies(tokens, width)
    freqs.coalesce(1).write.parquet(f"{path}/freqs")
    model = spark.sparkContext.broadcast(_model(spark, path))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("_last")]

    def encode(batches):
        w = _Writer(model.value)
        for b in batches:
            for pid, doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                        b.column(2)):
                w.part = pid
                yield from w.add(doc_id, np.frombuffer(ids.as_buffer(), width))
        yield from w.flush()
        hashing.hand_back()
    # the last key only spreads equal rows over the parts
    (tokens.withColumn("_last", F.monotonically_increasing_id())
     .repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .select(F.spark_partition_id().alias("part"), "doc_id", "ids")
     .mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks"))
    model.destroy()
    discard(tokens)
    release(spark)


class _Writer:
    """Packs the documents of one part into blocks."""

    def __init__(self, model: Model):
        self.model, self.part, self.seq, self.block, self.first = model, 0, 0, 0, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[dict] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray):
        lengths, left = [], len(ids)
        room = BLOCK - self.held
        while left:
            lengths.append(min(left, room))
            left, room = left - lengths[-1], BLOCK
        at = 0
        for k, n in enumerate(lengths):
            self.ids.append(ids[at:at + n])
            self.docs.append({"seq": self.seq, "doc_id": doc_id, "n": n,
                              "start": self.first + self.held, "piece": k,
                              "pieces": len(lengths)})
            self.held += n
            at += n
            if self.held == BLOCK:
                yield from self.flush()
        self.seq += 1

    def flush(self):
        if not self.held:
            return
        ids = np.concatenate(self.ids).astype(np.uint32)
        payload, states, positions = encode_block(ids, self.model)
        yield pa.RecordBatch.from_pylist([{
            "part": self.part, "block": self.block, "first": self.first, "n": len(ids),
            "payload": payload, "states": states, "positions": positions,
            "crc": zlib.crc32(ids.astype("<u4").tobytes()), "docs": self.docs}], _BLOCK_SCHEMA)
        self.first += self.held
        self.block += 1
        self.ids, self.docs, self.held = [], [], 0


_BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
    ("payload", pa.binary()), ("states", pa.binary()), ("positions", pa.list_(pa.int64())),
    ("crc", pa.int64()), ("docs", pa.list_(pa.struct([
        ("seq", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("start", pa.int64()),
        ("piece", pa.int32()), ("pieces", pa.int32())])))])


def _model(spark: SparkSession, path: str) -> Model:
    """The frequency table on the driver: one row per id of the vocabulary."""
    t = spark.read.parquet(f"{path}/freqs").orderBy("id").toArrow()
    return Model(t["id"].to_numpy(), t["freq"].to_numpy())


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Decode every block; one row per document piece with the CRC-32 of its ids."""
    ship_package(spark)
    model = spark.sparkContext.broadcast(_model(spark, path))

    def decode(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = decode_block(row["n"], row["payload"], row["states"], row["positions"],
                                   model.value)
                raw = memoryview(ids.astype("<u4").tobytes())
                if zlib.crc32(raw) != row["crc"]:
                    raise ValueError(f"checksum of block {row['part']}/{row['block']} differs")
                out, at = [], 0
                for d in row["docs"]:
                    out.append({"part": row["part"], "seq": d["seq"], "doc_id": d["doc_id"],
                                "start": d["start"], "n": d["n"], "piece": d["piece"],
                                "pieces": d["pieces"],
                                "crc": zlib.crc32(raw[4 * at:4 * (at + d["n"])])})
                    at += d["n"]
                yield pa.RecordBatch.from_pylist(out, _PIECE_SCHEMA)
        hashing.hand_back()
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(decode, PIECES)


_PIECE_SCHEMA = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
    ("n", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()), ("crc", pa.int64())])


def joined_crc(first: int, second: int, n_bytes: int) -> int:
    """CRC-32 of two byte strings in a row, from theirs and the second's length."""
    while n_bytes > 0:
        zeros = bytes(min(n_bytes, 1 << 20))
        first = zlib.crc32(zeros, first) ^ zlib.crc32(zeros)
        n_bytes -= len(zeros)
    return first ^ second


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: global start, tokens and CRC-32."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part
    offsets = blocks.groupBy("part").agg(F.sum("n").alias("_n")).select(
        F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pieces = written_table(read_pieces(spark, path), "pieces")

    def whole(frame):
        frame = frame.sort_values("piece")
        crc, n = 0, 0
        for c, k in zip(frame["crc"], frame["n"]):
            crc, n = joined_crc(crc, int(c), 4 * int(k)), n + int(k)
        return frame.head(1).assign(crc=crc, n=n)
    docs = pieces.filter("pieces = 1").unionByName(
        pieces.filter("pieces > 1").groupBy("part", "seq").applyInPandas(whole, PIECES))
    return (docs.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
            .select("doc_id", (F.col("_off") + F.col("start")).alias("start"),
                    F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode_corpus(docs: DataFrame, path: str, tokenizer_path: str | None = None) -> DataFrame:
    """Write the files of ``docs`` below ``path`` and return their documents, read back."""
    write(docs, tokenizer_path or default_tokenizer(), path)
    return read_documents(docs.sparkSession, path)
