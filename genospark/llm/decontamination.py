"""Benchmark decontamination over a distributed positional inverted index.

The documents are cut into segments of whole texts.  A segment stores the sorted
terms of its texts and, for each term, the ascending list of its word positions;
segments are the rows of a Parquet table, so postings are spread over the
cluster and a phrase, which lies within one text, lies within one segment.

A test phrase is looked up in every segment: a phrase with an absent term is
done after the look-up of its terms; else the list of its rarest term, shifted by
the term's offset, gives the candidate starts, and the shifted lists of the other
terms, rarest first, are intersected with them.  Test phrases are sent to the
tasks in blocks of bounded size.

Words are the runs of letters a-z (A-Z lower-cased), digits and non-ASCII
characters, known by their 64-bit hash (see ``textarrays``).

Defined cases: a null or empty text has no words and is never hit; an item
without words has no window; rows that repeat an id are judged one by one; other
columns are not read; without documents the result has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T
from genospark.session import scratch_path, stored

WINDOW = 10
#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 1 << 20
#: Distinct test phrases sent to the tasks at once.
BLOCK = 200_000

INDEX_SCHEMA = ("segment long, doc_ids array<long>, n_words array<int>, "
                "terms binary, counts binary, positions binary")


@T.releases
def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        data, offsets = T.buffers(batch.column(1))
        for i, j in T.slices(offsets, SEGMENT_BYTES):
            own = offsets[i:j + 1] - offsets[i]
            terms, first = T.words(data[offsets[i]:offsets[j]], own, T.ALNUM)
            order = np.argsort(terms, kind="stable")
            distinct, counts = T.counted(terms)
            yield pa.RecordBatch.from_pydict({
                "segment": [number], "doc_ids": [batch.column(0).slice(i, j - i).to_pylist()],
                "n_words": [np.diff(first).astype(np.int32)], "terms": [distinct.tobytes()],
                "counts": [counts.astype(np.uint32).tobytes()],
                "positions": [order.astype(np.uint32).tobytes()],
            }, schema=pa.schema([("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                                 ("n_words", pa.list_(pa.int32())), ("terms", pa.binary()),
                                 ("counts", pa.binary()), ("positions", pa.binary())]))
            number += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of ``docs``, stored."""
    T.bounded_batches(docs.sparkSession, T.SMALL_BATCH_BYTES)
    return stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                  .mapInArrow(_index, INDEX_SCHEMA), "positional-index")


class Segment:
    """One row of the index."""

    def __init__(self, row: dict):
        self.n_words = np.asarray(row["n_words"], np.int64)
        self.doc_first = np.concatenate(([0], np.cumsum(self.n_words)))
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], np.uint32).astype(np.int64)
        self.list_first = np.concatenate(([0], np.cumsum(self.counts)))
        # term number and position in one sorted key: all lists can be searched at once
        self.keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the terms in this segment, -1 if absent."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def holds(self, number: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Is the position in the term's list?"""
        key = (number << 32) | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (position >= 0)

    def next(self, number: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first position of the term's list that is not before the given one; very large if none."""
        at = np.searchsorted(self.keys, (number << 32) | np.maximum(position, 0))
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (key >> 32 == number), key & 0xFFFFFFFF, 1 << 40)


class Phrases:
    """A block of test phrases: padded rows of term hashes."""

    def __init__(self, ids: list[int], keys: list[bytes]):
        self.ids = np.asarray(ids, np.int64)
        rows = [np.frombuffer(k, np.uint64) for k in keys]
        self.size = np.asarray([len(r) for r in rows], np.int64)
        self.width = int(self.size.max(initial=1))
        flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        self.vocabulary, at = np.unique(flat, return_inverse=True)
        self.term = np.full((len(rows), self.width), -1, np.int64)
        self.term[np.arange(self.width) < self.size[:, None]] = at

    def candidates(self, seg: Segment):
        """Phrases all of whose terms the segment has, their term numbers and offsets rarest
        first, and each occurrence of the rarest term: (phrase row, its position)."""
        number = seg.find(self.vocabulary)
        absent = np.append(number < 0, False)  # the last entry stands for padding
        alive = np.flatnonzero(~absent[self.term].any(axis=1))
        numbers = np.append(number, 0)[self.term[alive]]
        often = np.where(self.term[alive] >= 0, seg.counts[numbers] if len(seg.counts) else 0, 1 << 40)
        order = np.argsort(often, axis=1, kind="stable")
        numbers = np.take_along_axis(numbers, order, 1)
        rare = numbers[:, 0] if len(alive) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(alive)), seg.counts[rare])
        return alive, numbers, order, row, seg.positions[T.ranges(seg.list_first[rare], seg.counts[rare])]


def exact_matches(seg: Segment, phrases: Phrases):
    """(phrase row, start, end) of every exact occurrence within one text."""
    alive, numbers, order, row, position = phrases.candidates(seg)
    start = position - order[row, 0] if len(row) else position
    for k in range(1, phrases.width):
        size = phrases.size[alive[row]]
        ok = (k >= size) | seg.holds(numbers[row, k], start + order[row, k]) if len(row) else np.zeros(0, bool)
        row, start = row[ok], start[ok]
    end = start + phrases.size[alive[row]]
    doc = np.searchsorted(seg.doc_first, start, "right") - 1
    ok = (start >= 0) & (end <= seg.doc_first[np.minimum(doc + 1, len(seg.doc_first) - 1)])
    return alive[row[ok]], start[ok], end[ok]


def near_matches(slop: int) -> Callable:
    """A matcher: all terms of the phrase, in any order, within its length plus ``slop`` words."""
    def match(seg: Segment, phrases: Phrases):
        alive, numbers, order, row, position = phrases.candidates(seg)
        best_start, best_end = np.full(len(row), -1), np.full(len(row), -1)
        size = phrases.size[alive[row]]
        doc = np.searchsorted(seg.doc_first, position, "right") - 1
        for back in range(phrases.width + slop):  # later starts first: the tightest match stays
            start, end = position - back, position.copy()
            ok = (best_start < 0) & (back < size + slop) & (start >= seg.doc_first[doc])
            limit = np.minimum(start + size + slop, seg.doc_first[np.minimum(doc + 1, len(seg.doc_first) - 1)])
            for k in range(phrases.width):
                at = seg.next(numbers[row, k], start) if len(row) else position
                ok &= (k >= size) | (at < limit)
                end = np.where(ok & (k < size), np.maximum(end, at), end)
            best_start, best_end = np.where(ok, start, best_start), np.where(ok, end + 1, best_end)
        ok = best_start >= 0
        return alive[row[ok]], best_start[ok], best_end[ok]
    return match


MATCH_SCHEMA = "segment long, at int, phrase_id long, start int, end int"
HIT_SCHEMA = "segment long, at int, phrase_ids array<long>, spans array<struct<start: int, end: int>>"


def _each_segment(batches: Iterator[pa.RecordBatch], match: Callable, phrases: Phrases):
    for batch in batches:
        for row in batch.to_pylist():
            seg = Segment(row)
            which, start, end = match(seg, phrases)
            doc = np.searchsorted(seg.doc_first, start, "right") - 1
            yield row["segment"], seg, which, doc, start, end


def _matches(match: Callable, phrases: Phrases):
    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, seg, which, doc, start, end in _each_segment(batches, match, phrases):
            first = seg.doc_first[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(which), segment)), pa.array(doc.astype(np.int32)),
                 pa.array(phrases.ids[which]), pa.array((start - first).astype(np.int32)),
                 pa.array((end - first).astype(np.int32))],
                names=["segment", "at", "phrase_id", "start", "end"])
    return run


def _hits(match: Callable, phrases: Phrases):
    """One row for each hit text: the phrases that occur and the merged spans."""
    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, seg, which, doc, start, end in _each_segment(batches, match, phrases):
            out = {"segment": [], "at": [], "phrase_ids": [], "spans": []}
            order = np.lexsort((start, doc))
            which, doc, start, end = which[order], doc[order], start[order], end[order]
            docs, first = np.unique(doc, return_index=True)
            for d, i, j in zip(docs.tolist(), first, np.append(first, len(doc))[1:], strict=True):
                reach = np.maximum.accumulate(end[i:j])
                cut = np.concatenate(([0], np.flatnonzero(start[i + 1:j] > reach[:-1]) + 1))
                stop = np.concatenate((cut[1:], [j - i])) - 1
                out["segment"].append(segment)
                out["at"].append(d)
                out["phrase_ids"].append(np.unique(phrases.ids[which[i:j]]).tolist())
                out["spans"].append([{"start": int(a), "end": int(b)}
                                     for a, b in zip(start[i:j][cut], reach[stop], strict=True)])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("segment", pa.int64()), ("at", pa.int32()), ("phrase_ids", pa.list_(pa.int64())),
                ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))
    return run


def _windows(size: int):
    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.buffers(batch.column(1))
            terms, first = T.words(data, offsets, T.ALNUM)
            ids, keys = [], []
            for item, i, j in zip(batch.column(0).to_pylist(), first[:-1], first[1:], strict=True):
                found = {terms[a:min(a + size, j)].tobytes() for a in range(i, max(i + 1, j - size + 1)) if j > i}
                ids += [item] * len(found)
                keys += found
            yield pa.RecordBatch.from_pydict(
                {"item_id": ids, "key": keys}, schema=pa.schema([("item_id", pa.int64()), ("key", pa.binary())]))
    return run


def phrase_table(items: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The windows of ``size`` words of the test items (an item of fewer words is one window):
    (phrase_id, key) and (item_id, phrase_id), both stored."""
    windows = stored(items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                     .mapInArrow(_windows(size), "item_id long, key binary"), "windows")
    phrases = stored(windows.select("key").distinct()
                     .select(F.monotonically_increasing_id().alias("phrase_id"), "key"), "phrases")
    return phrases, stored(windows.join(phrases, "key").select("item_id", "phrase_id").distinct(), "item-phrases")


def _over_blocks(index: DataFrame, phrases: DataFrame, wrap: Callable, match: Callable, schema: str,
                 name: str) -> DataFrame:
    """All segments against the phrases, a bounded block of them at a time; stored block by
    block, so the driver holds only one."""
    blocks = max(1, -(-phrases.count() // BLOCK))
    path = scratch_path(index.sparkSession, name)
    for b in range(blocks):
        _write_block(index, phrases.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b), wrap, match, schema, path)
    return index.sparkSession.read.schema(schema).parquet(path)


def _write_block(index: DataFrame, phrases: DataFrame, wrap: Callable, match: Callable, schema: str, path: str) -> None:
    part = phrases.toArrow()
    block = Phrases(part["phrase_id"].to_pylist(), part["key"].to_pylist())
    index.mapInArrow(wrap(match, block), schema).write.mode("append").parquet(path)


def find_matches(index: DataFrame, phrases: DataFrame, match: Callable = exact_matches) -> DataFrame:
    """Every match as (doc_id, phrase_id, start, end), in words of the text; ``match`` is
    ``exact_matches`` or ``near_matches(slop)``."""
    ids = index.select("segment", F.posexplode("doc_ids").alias("at", "doc_id"))
    return (_over_blocks(index, phrases, _matches, match, MATCH_SCHEMA, "matches")
            .join(ids, ["segment", "at"]).select("doc_id", "phrase_id", "start", "end"))


def _covered(spans: Column) -> Column:
    """Words under a list of spans that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reach"))
    return F.aggregate(F.array_sort(spans), start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["reach"], s["start"]))).alias("n"),
        F.greatest(acc["reach"], s["end"]).alias("reach")), lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, match: Callable = exact_matches) -> DataFrame:
    """Judge every document against the windows of all test items.

    Returns a row for each document row: doc_id, n_words, n_hit (words inside an
    occurrence of a window), n_items (items with occurring windows), items_sha256
    (of their ids, sorted as strings and joined by commas) and contaminated.
    """
    index = build_index(docs)
    phrases, item_phrases = phrase_table(items, size)
    hits = _over_blocks(index, phrases, _hits, match, HIT_SCHEMA, "hits")
    key = ["segment", "at"]
    spans = hits.groupBy(*key).agg(_covered(F.flatten(F.collect_list("spans"))).alias("n_hit"))
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    found = (hits.select(*key, F.explode("phrase_ids").alias("phrase_id")).join(item_phrases, "phrase_id")
             .groupBy(*key).agg(ids.alias("items")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("at", "doc"))
            .join(spans.join(found, key), key, "left")
            .select(F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").cast("long").alias("n_words"),
                    n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated")))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + 9], ' ') AS gram
  FROM b, unnest(range(1, greatest(2, len(ws) - 8))) AS t(i) WHERE len(ws) > 0),
grams AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM w, (SELECT DISTINCT n FROM win), unnest(range(1, len(ws) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, item_id, i, n FROM grams JOIN win USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
