"""Repeated byte strings by external induced sorting.

Texts are cut into shards of related content: the anchor of a 50-byte window is
the string around the one of its 8-byte strings that has the least hash, so all
copies of a window have one anchor and meet in one shard, whatever documents
they are in (see ``repeats``; equal contexts count once, and a context alone
with its anchor has nothing to be compared with).  Within a shard the suffixes of all contexts are sorted and
windows equal to each other are neighbours whose common prefix spans them.

Sorting is by induction.  The leftmost S-type (LMS) suffixes are sorted first,
by rounds that name ever longer runs of LMS substrings after their rank, until
names cover a window.  Then one pass upwards induces the L-type suffixes and
one downwards the S-type ones: a queue ordered by first byte hands out suffix
tuples (place, common prefix with the one before) in order, and each tuple
puts the suffix one byte to its left into the queue, with a common prefix one
longer than the least one passed since that byte was last put.  As tuples
arrive in order, a queue is a list of blocks for each byte; blocks beyond
``QUEUE_BYTES`` go to a temporary file of the task, so a shard's tuples may
exceed memory.  Shards are read in chunks that end between anchors, and an
anchor with over ``SPLIT`` different contexts is divided by window first, so no
chunk depends on how often a string occurs.

Defined results: null and blank texts have no bytes; rows that share an id are
one document and no repeats of each other; documents without an id come after
all others and are one document; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm import hashing
from rankfold.llm.repeats import Runs, disjoint, identified, repeated

# Fixed value: bytes in a window.
WINDOW = 50
# Production parameters.
GRAM = 8
HALF = 22
CHUNK_BYTES = 2 << 20
QUEUE_BYTES = 64 << 20
SPLIT = 20_000

U = np.uint64
ORDER = ["doc"]
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "kept binary, spans array<struct<a:long,b:long>>")


# ---------------------------------------------------------------- shards
def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number; zeros follow the end."""
    room = np.zeros(len(data) + 8, np.uint8)
    room[:len(data)] = data
    return np.lib.stride_tricks.as_strided(room[:8].view("<u8"), (len(data) + 1,), (1,))


def _least_places(rank: np.ndarray, width: int) -> np.ndarray:
    """The first place of the least value in each window of ``width``."""
    at = np.arange(len(rank), dtype=np.int32)

    def joined(rank, at, step):
        later = rank[step:] < rank[:-step]
        return (np.minimum(rank[:-step], rank[step:]), np.where(later, at[step:], at[:-step]))
    k = 1
    while 2 * k <= width:
        rank, at = joined(rank, at, k)
        k *= 2
    return joined(rank, at, width - k)[1] if width > k else at


class _Runs(Runs):
    """Runs of byte windows; see ``repeats``.

    Windows with one least 8-byte string are told apart by whether it begins in their
    first ``HALF`` bytes, and the anchor is all bytes around it that any of them holds.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        if len(data) < WINDOW:
            self.begin = self.n = np.empty(0, np.int64)
            self.key = np.empty(0, U)
            return
        eights = _eights(data)
        rank = ((eights[:len(data) - GRAM + 1] * hashing.ODD[24]) >> U(32)).astype(np.uint32)
        place = _least_places(rank, WINDOW - GRAM + 1)
        n_windows = np.maximum(np.diff(off) - WINDOW + 1, 0)
        some = n_windows > 0
        firsts, lasts = off[:-1][some], off[:-1][some] + n_windows[some]
        edge = np.zeros(len(place) + 1, np.int8)
        edge[firsts] = 1
        edge[lasts] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        late = place - np.arange(len(place), dtype=np.int32) >= HALF
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (late[1:] != late[:-1]) | (edge[1:-1] != 0)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(place))
        use = inside[begin]
        self.begin = begin[use]
        self.n = stop[use] - self.begin
        late = late[self.begin]
        a = place[self.begin] - np.where(late, HALF, 0)
        size = np.where(late, HALF + GRAM, WINDOW - HALF + 1)
        self.key = hashing.mix(
            eights[a] * hashing.ODD[25] + eights[a + 8] * hashing.ODD[26]
            + eights[a + 16] * hashing.ODD[27] + eights[a + size - 8] * hashing.ODD[28]
            + late.astype(np.uint64))

    def places(self, k):
        row = np.searchsorted(self.off, self.begin[k], "right") - 1
        return row, self.begin[k] - self.off[row], self.n[k]

    def hashes(self, k):
        """Of all bytes from a run's first window to the end of its last."""
        a = self.begin[k]
        return hashing.word_hashes(self.data, a, a + self.n[k] + (WINDOW - 1))

    def content(self, k):
        return [self.data[x:x + c + WINDOW - 1].tobytes()
                for x, c in zip(self.begin[k].tolist(), self.n[k].tolist())]


# ---------------------------------------------------------------- induced sorting
class Queue:
    """Tuples (place, common prefix) by first byte, in the order they were put.

    Beyond ``QUEUE_BYTES`` in memory, blocks of tuples go to a temporary file.
    """

    def __init__(self, symbols: int, limit: int):
        self.blocks: list[list] = [[] for _ in range(symbols)]
        self.limit, self.held, self.file = limit, 0, None

    def put(self, symbol: int, place: np.ndarray, common: np.ndarray):
        if self.held + 5 * len(place) > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            at = self.file.seek(0, 2)
            self.file.write(place.tobytes())
            self.file.write(common.tobytes())
            self.blocks[symbol].append((at, len(place)))
        else:
            self.held += 5 * len(place)
            self.blocks[symbol].append((place, common))

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        places, commons = [np.empty(0, np.int32)], [np.empty(0, np.uint8)]
        for a, b in self.blocks[symbol]:
            if isinstance(a, np.ndarray):
                self.held -= 5 * len(a)
                places.append(a)
                commons.append(b)
            else:
                self.file.seek(a)
                places.append(np.frombuffer(self.file.read(4 * b), np.int32))
                commons.append(np.frombuffer(self.file.read(b), np.uint8))
        self.blocks[symbol] = []
        return np.concatenate(places), np.concatenate(commons)

    def close(self):
        if self.file is not None:
            self.file.close()


class _Since:
    """The least common prefix passed since a symbol was last put, and range minima."""

    def __init__(self, symbols: int):
        self.least = np.full(symbols, -1, np.int16)  # -1: nothing put yet, prefix 0

    def puts(self, symbol: np.ndarray, pick: np.ndarray, common: np.ndarray
             ) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For a block of passed tuples with their ``common``, of which ``pick`` (indices,
        rising) put a suffix beginning with ``symbol``: (symbol, indices, common prefixes)
        for each symbol, in order."""
        if not len(pick):
            self.least = np.minimum(self.least, int(common.min()) if len(common) else 255)
            return []
        tables = [common]
        while 2 ** len(tables) <= len(common):
            t, k = tables[-1], 2 ** (len(tables) - 1)
            tables.append(np.minimum(t[:-k], t[k:]))

        def least(a, b):  # of common[a:b], 255 where empty
            n = b - a
            out = np.full(len(a), 255, np.uint8)
            for k, t in enumerate(tables):
                own = np.flatnonzero((n >= 2 ** k) & (n < 2 ** (k + 1)))
                if len(own):
                    out[own] = np.minimum(t[a[own]], t[b[own] - 2 ** k])
            return out
        order = np.argsort(symbol, kind="stable")
        pick, symbol = pick[order], symbol[order]
        head = np.ones(len(pick), bool)
        head[1:] = symbol[1:] != symbol[:-1]
        before = np.empty(len(pick), np.int64)
        before[1:] = pick[:-1] + 1
        before[head] = 0
        low = least(before, pick + 1).astype(np.int16)
        heads = np.flatnonzero(head)
        low[heads] = np.minimum(low[heads], self.least[symbol[heads]])
        self.least = np.minimum(self.least, int(common.min()))
        ends = np.append(heads[1:], len(pick))
        last = pick[ends - 1] + 1
        self.least[symbol[heads]] = least(last, np.full(len(last), len(common)))
        grown = np.minimum(low + 1, WINDOW).astype(np.uint8)
        return [(int(symbol[a]), pick[a:b], grown[a:b]) for a, b in zip(heads, ends)]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefixes, up to ``WINDOW``, of the suffixes at ``a`` and at ``b`` (all
    different), compared four 16-bit symbols at a time."""
    n = len(text)
    room = np.zeros(n + 4, "<u2")
    room[:n] = text
    four = np.lib.stride_tricks.as_strided(room.view(np.uint8)[:8].view("<u8"), (n + 1,), (2,))
    out = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    for k in range(0, WINDOW, 4):
        x, y = a[going] + k, b[going] + k
        differ = four[np.minimum(x, n)] ^ four[np.minimum(y, n)]
        same = ((differ & U(0xFFFF)) == 0).astype(np.int64)
        same += same * ((differ & U(0xFFFF0000)) == 0)
        same += (same == 2) * ((differ & U(0xFFFF00000000)) == 0)
        same += (same == 3) * ((differ >> U(48)) == 0)
        out[going] = k + same
        going = going[same == 4]
        if not len(going):
            break
    return np.minimum(np.minimum(out, WINDOW), n - np.maximum(a, b)).astype(np.uint8)


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is S-type: smaller than the one after it."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    nxt = np.full(n, n - 1)
    nxt[differs] = differs
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    small = np.zeros(n, bool)
    inner = nxt < n - 1
    small[inner] = text[nxt[inner]] < text[np.minimum(nxt[inner] + 1, n - 1)]
    return small  # the last run of symbols is L-type: the end is smaller than any symbol


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    values, rank = np.unique(keys, return_inverse=True)
    return rank.astype(np.uint64), len(values)


def _sorted_lms(text: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The LMS places in the order of their suffixes, by their first ``WINDOW`` symbols.

    The first names are the ranks of the LMS substrings (from one place to the next); each
    round then names a place after its own name and that of the place where its name
    ends, until names cover a window.
    """
    n, m = len(text), len(lms)
    if m < 2:
        return lms
    size = np.append(lms[1:] + 1, n) - lms
    # a substring that ends sorts after one that goes on (the end is S-type, the other L-type);
    # the end of the text sorts before all
    pad = np.full(m, 258, np.uint64)
    pad[-1] = 0

    def word(rows, w):
        acc = np.zeros(len(rows), np.uint64)
        for k in range(7 * w, 7 * w + 7):
            sym = text[np.minimum(lms[rows] + k, n - 1)].astype(np.uint64) + U(1)
            acc = acc * U(259) + np.where(k < size[rows], sym, pad[rows])
        return acc
    name, count = _ranks(word(np.arange(m), 0))
    for w in range(1, -(-WINDOW // 7)):
        rows = np.flatnonzero(size > 7 * w)
        if not len(rows):
            break
        own, other = _ranks(word(rows, w))
        more = np.full(m, other, np.uint64)
        more[rows] = own
        name, count = _ranks(name * U(other + 1) + more)
    units = 1
    while count < m and units < m:
        ahead = np.full(m, np.iinfo(np.int64).max)
        ahead[:-units] = lms[units:] - lms[:-units]
        if ahead.min() >= WINDOW:
            break
        after = np.zeros(m, np.uint64)
        after[:-units] = name[units:] + U(1)
        name, count = _ranks(name * U(m + 1) + after)
        units *= 2
    return lms[np.argsort(name, kind="stable")]


def induced_sort(text: np.ndarray, symbols: int = 257, queue_bytes: int = QUEUE_BYTES
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix with the suffix before), by the first ``WINDOW``
    symbols: suffixes equal that far are in no particular order, prefixes are cut there."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32), np.zeros(n, np.uint8)
    small = _types(text)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = _sorted_lms(text, np.flatnonzero(is_lms)).astype(np.int32)
    lms_common = np.zeros(len(lms), np.uint8)
    if len(lms) > 1:
        lms_common[1:] = _common(text, lms[:-1].astype(np.int64), lms[1:].astype(np.int64))
    starts = np.searchsorted(text[lms], np.arange(symbols + 1))

    def seam(a, b):
        return int(_common(text, np.array([a], np.int64), np.array([b], np.int64))[0])

    def induce(queue, since, block, common, want_small, same):
        """Puts what a block of tuples induces; what begins with ``same`` is returned."""
        before = block.astype(np.int64) - 1
        pick = np.flatnonzero((before >= 0) & (small[before] == want_small))
        back = np.empty(0, np.int32), np.empty(0, np.uint8)
        for s, at, c in since.puts(text[before[pick]].astype(np.int64), pick, common):
            places = before[at].astype(np.int32)
            if s == same:
                back = places, c
            else:
                queue.put(s, places, c)
        return back
    # upwards: the last suffix comes first, then L-type and LMS suffixes by symbol
    queue, since = Queue(symbols, queue_bytes), _Since(symbols)
    large: list[tuple[np.ndarray, np.ndarray]] = []
    queue.put(int(text[-1]), np.array([n - 1], np.int32), np.zeros(1, np.uint8))
    since.least[int(text[-1])] = 255
    for s in range(symbols):
        block, common = queue.take(s)
        done_p, done_c = [], []
        while len(block):
            done_p.append(block)
            done_c.append(common)
            block, common = induce(queue, since, block, common, False, s)
        p = np.concatenate(done_p) if done_p else np.empty(0, np.int32)
        large.append((p, np.concatenate(done_c) if done_c else np.empty(0, np.uint8)))
        own = lms[starts[s]:starts[s + 1]]
        if len(own):
            c = lms_common[starts[s]:starts[s + 1]].copy()
            c[0] = seam(p[-1], own[0]) if len(p) else 0
            induce(queue, since, own, c, False, -1)
    queue.close()
    # downwards: S-type and L-type suffixes by symbol, each with the prefix it shares with
    # the next larger one
    queue, since = Queue(symbols, queue_bytes), _Since(symbols)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for s in range(symbols - 1, -1, -1):
        block, common = queue.take(s)
        done_p, done_c = [], []
        while len(block):
            done_p.append(block)
            done_c.append(common)
            block, common = induce(queue, since, block, common, True, s)
        sp = np.concatenate(done_p) if done_p else np.empty(0, np.int32)
        sc = np.concatenate(done_c) if done_c else np.empty(0, np.uint8)
        lp, lc = large[s]
        # ascending: L-type, then S-type reversed
        places = np.concatenate([lp, sp[::-1]])
        shared = np.zeros(len(places), np.uint8)
        shared[:len(lp)] = lc
        if len(lp):
            shared[0] = 0
        if len(sp) and len(lp):
            shared[len(lp)] = seam(lp[-1], sp[-1])
        if len(sp) > 1:
            shared[len(lp) + 1:] = sc[1:][::-1]
        out.append((places, shared))
        if len(lp):
            down = np.zeros(len(lp), np.uint8)
            down[1:] = lc[1:][::-1]
            down[0] = shared[len(lp)] if len(sp) else 0
            induce(queue, since, lp[::-1], down, True, -1)
    queue.close()
    out.reverse()
    return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])


def first_owners(contexts: list[bytes], owner: np.ndarray, queue_bytes: int = QUEUE_BYTES
                 ) -> list[np.ndarray]:
    """For every window of every context, the least owner of an equal window."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    text = np.zeros(int(sizes.sum()) + len(contexts), np.uint16)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    inside = np.ones(len(text), bool)
    inside[begin[1:] - 1] = False
    text[inside] = raw.astype(np.uint16) + 1  # 0 ends a context
    places, common = induced_sort(text, 257, queue_bytes)
    group = np.cumsum(common < WINDOW) - 1
    of = np.searchsorted(begin, places, "right") - 1
    first = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, group, owner[of])
    best = np.empty(len(text), np.int64)
    best[places] = first[group]
    return [best[b:b + s - WINDOW + 1] for b, s in zip(begin[:-1].tolist(), sizes.tolist())]


# ---------------------------------------------------------------- Spark
def _sort_shards(batches):
    """Rows (shard, key, run, at, doc, content) by shard: the windows that also occur in an
    earlier document, as ranges."""
    held: list[tuple] = []
    size, shard = 0, None

    def resolved():
        first = first_owners([h[4] for h in held], np.array([h[3] for h in held], np.int64))
        out = []
        for (key, run, at, doc, _), least in zip(held, first):
            late = np.flatnonzero(least < doc)
            if len(late):
                cut = np.flatnonzero(np.diff(late) > 1)
                a = late[np.concatenate([[0], cut + 1])] + at
                b = late[np.concatenate([cut, [len(late) - 1]])] + at + 1
                out.append({"key": key, "run": run, "part": [
                    {"a": int(x), "b": int(y)} for x, y in zip(a, b)]})
        return pa.RecordBatch.from_pylist(out, _PARTS)
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(6)]
        for row in zip(*cols):
            if row[0] != shard and size >= CHUNK_BYTES:
                yield resolved()
                held, size = [], 0
            shard = row[0]
            held.append(row[1:])
            size += len(row[5])
    if held:
        yield resolved()
        held = []
    hashing.hand_back()


_PART_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_PARTS = pa.schema([("key", pa.int32()), ("run", pa.int64()), ("part", _PART_TYPE)])


def _resolve(rows: DataFrame) -> DataFrame:
    """Ranges of windows that also occur in an earlier document, by shards of anchors."""
    whole = rows.filter(F.col("of_key") <= SPLIT).select(
        F.col("key").alias("shard"), "key", "run", F.lit(0).alias("at"),
        F.col("m").alias("doc"), "content")
    # an anchor with very many contexts is divided by the windows themselves
    split = rows.filter(F.col("of_key") > SPLIT).select(
        "key", "run", F.col("m").alias("doc"), "content",
        F.explode(F.sequence(F.lit(0), F.octet_length("content") - WINDOW)).alias("at")).select(
        "key", "run", "doc", "at", F.substring("content", F.col("at") + 1, F.lit(WINDOW))
        .alias("content"))
    least = split.groupBy("content").agg(F.min("doc").alias("_least"))
    late = split.join(least, "content").filter(F.col("doc") > F.col("_least")).select(
        "key", "run", "at")
    return (whole.repartition("shard").sortWithinPartitions("shard", "run")
            .select("shard", "key", "run", "at", "doc", "content")
            .mapInArrow(_sort_shards, "key int, run long, part array<struct<a:int,b:int>>")
            .unionByName(late.groupBy("key", "run").agg(F.collect_list(F.struct(
                F.col("at").alias("a"), (F.col("at") + 1).alias("b"))).alias("part"))))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document row: byte counts, hash and bytes of what is kept, and the
    removed spans of bytes."""
    own = identified(docs)
    cuts = repeated(own, _Runs, WINDOW, ORDER, _resolve).select(
        F.col("doc").alias("_d"), F.col("tie").alias("_t"), "cuts")

    def apply(batches):
        for b in batches:
            for lo, hi, data, off in hashing.slices(b.column(1)):
                yield _cut(b.column(0).slice(lo, hi - lo), data, off,
                           b.column(2).slice(lo, hi - lo))
        hashing.hand_back()
    return (own.join(cuts, (F.col("doc") == F.col("_d")) & (F.col("tie") == F.col("_t")), "left")
            .select("doc_id", "text", "cuts").mapInArrow(apply, RESULT))


def _cut(doc_id: pa.Array, data: np.ndarray, off: np.ndarray, cuts: pa.Array) -> pa.RecordBatch:
    """The result's rows of a slice of texts and the spans to cut from each."""
    n = len(off) - 1
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(cuts), 0).to_numpy(
        zero_copy_only=False).astype(np.int64))])
    a, b = (x.to_numpy(zero_copy_only=False) for x in cuts.flatten().flatten())
    row, a, b = disjoint(np.repeat(np.arange(n), np.diff(ends)), a, b)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[off[row] + a] += 1
    edge[off[row] + b] -= 1  # one row's last span may end where the next row's first begins
    kept = data[np.cumsum(edge[:-1], dtype=np.int8) == 0]
    gone = np.zeros(n, np.int64)
    np.add.at(gone, row, b - a)
    size = np.diff(off)
    at = np.concatenate([[0], np.cumsum(size - gone)])
    raw = kept.tobytes()
    spans = np.bincount(row, minlength=n)
    return pa.RecordBatch.from_arrays([
        doc_id, pa.array(size, pa.int64()), pa.array(gone), pa.array(spans, pa.int64()),
        pa.array([hashlib.sha256(raw[x:y]).hexdigest()
                  for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.string()),
        pa.Array.from_buffers(pa.binary(), n, [
            None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)]),
        pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(spans)]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                       names=["a", "b"]))], schema=_SCHEMA)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()),
                     ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
