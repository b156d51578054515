"""Packing by lexical retrieval: windows of related documents from a sharded BM25 index.

Every document is encoded whole.  Windows that one document fills alone are cut off
first; the rest, less than a window, is what gets packed.  Rests are sharded by
their most telling token, so related ones meet, and each shard holds an inverted
index of its rests.  In a shard, the longest unused rest seeds a window and the
index returns its unused neighbours by BM25 score over all tokens of the seed, which fill the window in
turn; the last one is cut to fit and what is left of it stays unused.  Only a
shard's last window has padding.

Document frequencies and lengths are counted over all rests and are bounded by the
tokenizer's vocabulary, so they reach the tasks as one array.  Shards hold about
SHARD_TOKENS tokens: neighbouring tokens share a shard until it is full, and the
rests of a token with more than that are dealt to several shards by row.  Neighbours in
other shards are not found; the README has the measured recall.

Encoding: the tokenizer drops white space and never looks across it, so each
distinct word is encoded once a worker and texts are put together from the words'
ids; a punctuation mark after an ASCII letter starts a word of its own, as the
tokenizer's splitting does.

Defined cases: a null or empty text is the end token alone; rows that repeat an id
are packed one by one; other columns are not read; without documents there are no
pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from genospark.llm import textarrays as T
from genospark.session import stored

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
#: Distinct words a worker remembers; then the half that was not met lately goes.
CACHED_WORDS = 2_000_000
#: New words encoded at once; an encoding takes far more memory than its ids.
ENCODED_WORDS = 4096
#: Bits of a word's hash that name its place in the table of words met last.
PLACE_BITS = 19

_SPLIT = np.ones(256, bool)
_SPLIT[[0x20, 0x09, 0x0A, 0x0D]] = False
_MARK = np.zeros(256, bool)
_MARK[list(b",.;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class Words:
    """Words by the order of their hashes, and the ids of each in one array."""

    def __init__(self):
        self.words = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word, and whether it is there."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return at, self.words[at] == words if len(self.words) else np.zeros(len(words), bool)

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places, one after the other, and how many each has."""
        size = self.size[at].astype(np.int64)
        return self.flat[T.ranges(self.first[at], size)], size

    def add(self, words: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New words, sorted."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.used:self.used + len(ids)] = ids
        first = self.used + np.cumsum(size) - size
        self.used += len(ids)
        at = np.searchsorted(self.words, words)
        self.words, self.first, self.size = (np.insert(old, at, new) for old, new in (
            (self.words, words), (self.first, first), (self.size, size)))


class Places:
    """For each leading part of a hash, the word met last: its first id (in ``new.flat``) and number of ids."""

    def __init__(self):
        self.words = np.zeros(1 << PLACE_BITS, np.uint64)
        self.words[0] = ~np.uint64(0)  # no word of its place, as 0 is none of the others'
        self.first, self.size = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)

    @staticmethod
    def of(words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - PLACE_BITS)).astype(np.int64)

    def put(self, words: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        at = self.of(words)
        self.words[at], self.first[at], self.size[at] = words, first, size


class WordCache:
    """Ids of the words this worker has met lately."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library would start threads on all
        self.tokenizer = Tokenizer.from_file(path)
        self.new, self.old, self.places = Words(), Words(), Places()

    def lookup(self, words: np.ndarray, text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id (in ``new.flat``) and number of ids of each word; only those not in their places are sorted."""
        if len(self.new.words) > CACHED_WORDS // 2:
            self.old, self.new, self.places = self.new, Words(), Places()
        at = self.places.of(words)
        first, size = self.places.first[at], self.places.size[at]
        rest = np.flatnonzero(self.places.words[at] != words)
        if len(rest):
            distinct, at, which = np.unique(words[rest], return_index=True, return_inverse=True)
            own_first, own_size = self._distinct(distinct, text, start[rest[at]], end[rest[at]])
            first[rest], size[rest] = own_first[which], own_size[which]
            self.places.put(distinct, own_first, own_size)
        return first, size

    def _distinct(self, words: np.ndarray, text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of distinct words, which are sorted; unknown ones are encoded."""
        _, known = self.new.find(words)
        rest = np.flatnonzero(~known)
        at, known = self.old.find(words[rest])
        if known.any():
            self.new.add(words[rest[known]], *self.old.ids(at[known]))
        rest = rest[~known]
        if len(rest):
            spans = list(zip(start[rest].tolist(), end[rest].tolist(), strict=True))
            found = [e.ids for a in range(0, len(rest), ENCODED_WORDS) for e in self.tokenizer.encode_batch_fast(
                [text[i:j].decode() for i, j in spans[a:a + ENCODED_WORDS]], add_special_tokens=False)]
            size = np.fromiter(map(len, found), np.int64, len(found))
            self.new.add(words[rest], np.fromiter(chain.from_iterable(found), np.uint32, size.sum()), size)
        at, _ = self.new.find(words)
        return self.new.first[at], self.new.size[at].astype(np.int64)


_caches: dict[str, WordCache] = {}


def encode_texts(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts of a slice, each with its end id, and the bounds of the texts."""
    cache = _caches.get(path) or _caches.setdefault(path, WordCache(path))
    text, starts_at = T.spaced(data, offsets)
    solid = _SPLIT[text]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | (_MARK[text[1:]] & _LETTER[text[:-1]])
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | begins[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    begin, size = cache.lookup(T.SpanHash(text)(start, end), text.tobytes(), start, end)
    total = np.concatenate(([0], np.cumsum(size)))
    first = total[np.searchsorted(start, starts_at)]
    ids = cache.new.flat[T.ranges(begin, size)]
    return np.insert(ids, first[1:], END_ID), first + np.arange(len(first))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


REST_SCHEMA = "row long, first_window long, doc_id long, doc_tokens long, full_crcs array<long>, rest binary"
_REST = pa.schema([("row", pa.int64()), ("first_window", pa.int64()), ("doc_id", pa.int64()),
                   ("doc_tokens", pa.int64()), ("full_crcs", pa.list_(pa.int64())), ("rest", pa.binary())])


def _encode(path: str, dtype: np.dtype):
    """The windows that a text fills alone (their checksums) and the rest of it."""
    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = window = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        for batch in batches:
            data, offsets = T.buffers(batch.column(1))
            for i, j in T.slices(offsets, 2 * T.SLICE_BYTES):
                ids, first = encode_texts(path, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                crcs, rests = [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    cut = a + (b - a) // WINDOW * WINDOW
                    crcs.append([crc(ids[k:k + WINDOW]) for k in range(a, cut, WINDOW)])
                    rests.append(ids[cut:b].astype(dtype).tobytes())
                full = np.cumsum([0, *map(len, crcs)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + j - i)), pa.array(window + full[:-1]),
                     batch.column(0).slice(i, j - i), pa.array(np.diff(first)),
                     pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())], schema=_REST)
                row, window = row + j - i, window + int(full[-1])
    return run


class Terms:
    """What all rests together tell about each token."""

    def __init__(self, frequency: np.ndarray, rests: int, tokens: int, dtype):
        self.idf = np.log1p((rests - frequency + 0.5) / (frequency + 0.5))
        self.mean = max(tokens / max(rests, 1), 1.0)
        self.dtype = dtype
        self.by_rank = np.argsort(frequency, kind="stable")
        self.rank = np.empty_like(self.by_rank)
        self.rank[self.by_rank] = np.arange(len(frequency))

    def telling(self, rests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The rarest token of each rest (of equal ones the first) and the rest's length."""
        size = np.asarray([len(r.as_buffer()) for r in rests], np.int64) // self.dtype.itemsize
        ids = np.concatenate([np.frombuffer(r.as_buffer(), self.dtype) for r in rests])
        rarest = np.minimum.reduceat(self.rank[ids], np.concatenate(([0], np.cumsum(size)[:-1])))
        return self.by_rank[rarest], size


def _frequencies(size: int, dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, place, rests, tokens = np.zeros(size, np.int64), np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for rest in batch.column(0):
                ids = np.frombuffer(rest.as_buffer(), dtype).astype(np.int64)
                rests, tokens = rests + 1, tokens + len(ids)
                at = np.arange(len(ids))
                place[ids] = at  # one place of each distinct id: the work grows with the rest, not with the vocabulary
                frequency[ids[place[ids] == at]] += 1
        token = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(token, [size, size + 1])), pa.array(np.append(frequency[token], [rests, tokens]))],
            names=["token", "n"])
    return run


def _telling(terms: Broadcast, schema: pa.Schema):
    """Rows (.., rest) with the rest's telling token and length put before them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                token, size = terms.value.telling(batch.columns[-1])
                columns = [pa.array(token), pa.array(size), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns[:len(schema)], schema=schema)
    return run


def shard_plan(sizes: list, shard_tokens: int = SHARD_TOKENS) -> dict[int, tuple[int, int]]:
    """First shard and number of shards of each token, from (token, tokens of its rests)."""
    plan, shard, filled = {}, 0, 0
    for token, size in sorted(sizes):
        if filled and filled + size > shard_tokens:
            shard, filled = shard + 1, 0
        parts = -(-size // shard_tokens)
        plan[token] = shard, parts
        if parts > 1:
            shard, filled = shard + parts, 0
        else:
            filled += size
    return plan


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_PIECES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


def pack_shard(rests: list[np.ndarray], terms: Terms) -> Iterator[list[tuple[int, int, int, int]]]:
    """Windows as lists of (rest, start in it, length, offset in the window)."""
    n = len(rests)
    size = np.asarray([len(r) for r in rests])
    docs = np.repeat(np.arange(n), size)
    token_of = np.concatenate(rests).astype(np.int64)
    # postings: (token, rest) pairs in order, with their BM25 weights
    pairs, times = np.unique(token_of * n + docs, return_counts=True)
    token, doc = pairs // n, pairs % n
    weight = terms.idf[token] * times * (K1 + 1) / (times + K1 * (1 - B + B * size[doc] / terms.mean))
    first = np.searchsorted(token, np.arange(len(terms.idf) + 1))
    by_doc = np.argsort(doc, kind="stable")
    doc_first = np.searchsorted(doc[by_doc], np.arange(n + 1))

    used = np.zeros(n, np.int64)  # ids of each rest already in a window
    for seed in np.argsort(-size, kind="stable").tolist():
        if used[seed] == size[seed]:
            continue
        query = token[by_doc[doc_first[seed]:doc_first[seed + 1]]]
        lists = T.ranges(first[query], first[query + 1] - first[query])
        score = np.bincount(doc[lists], weight[lists], minlength=n)
        score[used == size] = -1
        score[seed] = np.inf
        window, room = [], WINDOW
        while room:
            at = int(score.argmax())
            if score[at] < 0:
                break
            take = min(room, int(size[at] - used[at]))
            window.append((at, int(used[at]), take, WINDOW - room))
            used[at] += take
            room -= take
            score[at] = -1
        yield window


def _pack(terms: Broadcast):
    def flush(shard: int, rows: list) -> pa.RecordBatch:
        rests = [np.frombuffer(r[3], terms.value.dtype) for r in rows]
        out = []
        for number, window in enumerate(pack_shard(rests, terms.value)):
            for at, start, length, offset in window:
                _, doc_id, doc_tokens, _ = rows[at]
                out.append((doc_id, doc_tokens - len(rests[at]) + start, length, crc(rests[at][start:start + length]),
                            doc_tokens, (shard << 28) + number, offset))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=_PIECES)

    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for s, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    if rows:
                        yield flush(shard, rows)
                    shard, rows = s, []
                rows.append(row)
        if rows:
            yield flush(shard, rows)
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pack all documents into sequences of at most WINDOW tokens.

    ``tokenizer`` is the path of a ``tokenizers`` file, the same on every machine.
    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset.
    """
    T.bounded_batches(docs.sparkSession, T.SMALL_BATCH_BYTES)
    spark = docs.sparkSession
    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    dtype = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
    encoded = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                     .mapInArrow(_encode(tokenizer, dtype), REST_SCHEMA), "encoded")
    rests = encoded.where("length(rest) > 0")

    counted = dict(rests.select("rest").mapInArrow(_frequencies(size, dtype), "token long, n long")
                   .groupBy("token").agg(F.sum("n").alias("n")).collect())
    frequency = np.asarray([counted.get(t, 0) for t in range(size)])
    terms = spark.sparkContext.broadcast(Terms(frequency, counted.get(size, 0), counted.get(size + 1, 0), dtype))

    sized = rests.select("rest").mapInArrow(
        _telling(terms, pa.schema([("token", pa.int64()), ("size", pa.int64())])), "token long, size long")
    sizes = [tuple(r) for r in sized.groupBy("token").agg(F.sum("size").alias("size")).collect()]
    # at most one row for each id of the tokenizer; an Arrow table needs no other kind of Python workers
    planned = [(t, s, p) for t, (s, p) in shard_plan(sizes, shard_tokens).items()] or [(-1, 0, 1)]
    plan = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*planned, strict=True)],
                                          names=["token", "shard", "parts"]))
    deal = F.pmod(F.xxhash64("row"), F.col("parts"))
    fields = [("token", pa.int64()), ("size", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()),
              ("doc_tokens", pa.int64()), ("rest", pa.binary())]
    sharded = (rests.select("row", "doc_id", "doc_tokens", "rest")
               .mapInArrow(_telling(terms, pa.schema(fields)),
                           "token long, size long, row long, doc_id long, doc_tokens long, rest binary")
               .join(F.broadcast(plan), "token").select((F.col("shard") + deal).alias("shard"), "row", "doc_id",
                                                        "doc_tokens", "rest"))
    packed = sharded.repartition("shard").sortWithinPartitions("shard", "row").mapInArrow(_pack(terms), PIECES)

    alone = encoded.where("size(full_crcs) > 0").select(
        "doc_id", "first_window", "doc_tokens", F.posexplode("full_crcs").alias("k", "ids_crc32"))
    window = F.lit(WINDOW).cast("long")
    # these windows are numbered below zero
    alone = alone.select(
        "doc_id", (F.col("k") * window).alias("start"), window.alias("length"), "ids_crc32", "doc_tokens",
        (-1 - F.col("first_window") - F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed)
