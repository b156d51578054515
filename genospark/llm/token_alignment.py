"""Cross-tokenizer alignment: which tokens of two tokenizers share bytes of a text.

Both sides cut the same bytes, so each token has a place.  A slice of documents is laid
end to end; its places are then keys that hold the document too.  ``pandas.merge_asof``
finds for each token start the other side's token that covers it, in both directions; the
union of the two is every pair of tokens that overlap, as the later start of such a
pair lies in the other token.  Places where tokens of both sides end cut them into groups.

``align`` returns the tokens, groups and links of each document.  ``link_counts`` also counts,
over all documents, how often each pair of ids is linked: a task folds the links of a bounded
chunk of documents to distinct pairs, Spark sums pairs over chunks and takes each B id's
highest, and the sums go back to the chunks that ask for them.  No table of pairs is
broadcast, as it grows with both vocabularies.

Tokenizers are files: ``.json`` a byte-level BPE of ``tokenizers``, read with special tokens as plain
text; ``.model`` one of ``sentencepiece``, which adds a space before the text.  Where a byte-level
file has nothing but merges in the order of its ids, ``tiktoken`` encodes with them as ranks, which gives the
same ids several times faster; any other file is encoded by its own library.

Defined cases: a null or empty text, or one whose joined token bytes differ from space and text
on either side, has no tokens, links or groups; rows that repeat an id or have none are aligned one by
one; other columns are not read; without documents there are no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from genospark.llm import textarrays as T
from genospark.session import stored

#: Distinct (document, pair) entries of a chunk; a chunk ends with the slice that fills it.
CHUNK_ENTRIES = 1 << 18


def byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 characters for
    themselves, the other bytes in order for the characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE; the text gets a space before it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        decode = byte_of_character()
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token: list[bytes] = [b""] * (max(ids.values()) + 1)
        for token, at in ids.items():
            self.token[at] = token.encode() if token in special else bytes(decode[c] for c in token)
        ranks = {self.token[at]: at for token, at in ids.items() if token not in special}
        if self._only_merges(spec, ranks):
            fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [fast.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        else:
            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in slow.encode_batch([" " + t for t in texts],
                                                                          add_special_tokens=False)]

    @staticmethod
    def _only_merges(spec: dict, ranks: dict[bytes, int]) -> bool:
        """Whether ids are the ranks of the merges and nothing else changes the text."""
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = (spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before["add_prefix_space"] and model["type"] == "BPE" and not model.get("dropout")
                 and not model.get("ignore_merges") and not model.get("end_of_word_suffix")
                 and not model.get("continuing_subword_prefix"))
        decode = byte_of_character()
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return bool(plain) and all(ranks.get(bytes(decode[c] for c in m)) == 256 + k for k, m in enumerate(merges))


class Pieces:
    """A sentencepiece model, which puts a space before the text."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token = [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode()
                      for k, p in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]
        self.encode = lambda texts: model.encode(texts, num_threads=1)


_loaded: dict[str, tuple] = {}


def loaded(path: str):
    """The tokenizer of a file and the bytes of each of its tokens, read once a worker."""
    if path not in _loaded:
        tokenizer = Pieces(path) if path.endswith(".model") else ByteLevel(path)
        _loaded[path] = tokenizer, np.asarray([len(t) for t in tokenizer.token], np.int64)
    return _loaded[path]


class Aligned:
    """The tokens of some documents on both sides, their overlaps and their groups."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        (a, self.size_a), (b, self.size_b) = loaded(path_a), loaded(path_b)
        texts = [t or "" for t in texts]
        all_a, all_b = a.encode(texts), b.encode(texts)
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            if not text or any(b"".join(map(side.token.__getitem__, ids[k])) != whole
                               for side, ids in ((a, all_a), (b, all_b))):
                all_a[k] = all_b[k] = ()
        self.first_a, self.first_b = (np.cumsum([0, *map(len, ids)]) for ids in (all_a, all_b))
        self.ids_a, self.ids_b = (np.fromiter(chain.from_iterable(ids), np.int64, first[-1])
                                  for ids, first in ((all_a, self.first_a), (all_b, self.first_b)))
        end_a, end_b = np.cumsum(self.size_a[self.ids_a]), np.cumsum(self.size_b[self.ids_b])
        start_a, start_b = end_a - self.size_a[self.ids_a], end_b - self.size_b[self.ids_b]
        self._link(start_a, start_b)
        # a group ends where tokens of both sides end; no token of either side crosses such a place
        self.group_end_a = np.isin(end_a, end_b, assume_unique=True)
        self.group_end_b = np.isin(end_b, end_a, assume_unique=True)

    def _link(self, start_a: np.ndarray, start_b: np.ndarray) -> None:
        """``link_a`` and ``link_b``: the token numbers of all overlaps, by A's and then B's number."""
        a = pd.DataFrame({"at": start_a, "a": np.arange(len(start_a))})
        b = pd.DataFrame({"at": start_b, "b": np.arange(len(start_b))})
        covered_a = pd.merge_asof(a, b, on="at")  # for each A token the B token over its start
        covered_b = pd.merge_asof(b, a, on="at")
        later = ~np.isin(start_b, start_a, assume_unique=True)  # equal starts are found by both
        link = np.concatenate((covered_a["a"].to_numpy(np.int64) << 32 | covered_a["b"].to_numpy(np.int64),
                               (covered_b["a"].to_numpy(np.int64) << 32 | covered_b["b"].to_numpy(np.int64))[later]))
        link.sort()
        self.link_a, self.link_b = link >> 32, link & 0xFFFFFFFF

    def documents(self, per_token: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sums of a value of each token (or link, by A's number) over each document."""
        total = np.concatenate(([0], np.cumsum(per_token)))
        return total[first[1:]] - total[first[:-1]]

    @property
    def first_link(self) -> np.ndarray:
        return np.searchsorted(self.link_a, self.first_a)


class GroupTexts:
    """The groups of a document as ``a1,a2|b1;a3|b2``: ids of A and B in decimal."""

    def __init__(self, n_a: int, n_b: int):
        n = max(n_a, n_b)
        self.n = n
        self.words = np.asarray([f"{i}{s}" for s in ",|;" for i in range(n)], object)

    def digests(self, x: Aligned) -> list[str]:
        after_a = np.where(x.group_end_a, self.n, 0) + x.ids_a
        after_b = np.where(x.group_end_b, 2 * self.n, 0) + x.ids_b
        group_a = np.cumsum(x.group_end_a) - x.group_end_a
        group_b = np.cumsum(x.group_end_b) - x.group_end_b
        # A's tokens of a group come before B's: a stable merge of two sorted lists
        at_a = np.arange(len(after_a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(after_b)) + np.searchsorted(group_a, group_b, "right")
        code = np.empty(len(after_a) + len(after_b), np.int64)
        code[at_a], code[at_b] = after_a, after_b
        words, bounds = self.words[code].tolist(), (x.first_a + x.first_b).tolist()
        return [hashlib.sha256("".join(words[i:j])[:-1].encode()).hexdigest() if i < j else ""
                for i, j in zip(bounds, bounds[1:], strict=False)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """Ids and texts of parts of the batches with bounded bytes, but for a single longer text."""
    for batch in batches:
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0), np.int64)
        for i, j in T.slices(np.concatenate(([0], np.cumsum(size)))):
            yield batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i).to_pylist()


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


_ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, "
            "a_link array<int>, b_link array<int>")


def _align(path_a: str, path_b: str):
    names = [c.split()[0] for c in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            x = Aligned(texts, path_a, path_b)
            group_a, group_b = (np.cumsum(e) - e for e in (x.group_end_a, x.group_end_b))
            groups = np.concatenate(([0], np.cumsum(x.documents(x.group_end_a, x.first_a))))
            n_a, n_b, n_links = np.diff(x.first_a), np.diff(x.first_b), np.diff(x.first_link)
            yield pa.RecordBatch.from_arrays(
                [ids, _lists(x.ids_a, x.first_a), _lists(x.ids_b, x.first_b),
                 _lists(group_a - np.repeat(groups[:-1], n_a), x.first_a),
                 _lists(group_b - np.repeat(groups[:-1], n_b), x.first_b),
                 _lists(x.link_a - np.repeat(x.first_a[:-1], n_links), x.first_link),
                 _lists(x.link_b - np.repeat(x.first_b[:-1], n_links), x.first_link)], names=names)
    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    T.bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document: ids of both sides, the group number of each token, and the links, as numbers of
    an A and a B token of the document (``a_link`` and ``b_link`` side by side)."""
    return _texts(docs, id_col, text_col).mapInArrow(_align(path_a, path_b), _ALIGNED)


_CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, entries array<long>, at array<int>, times array<int>, "
          "pair array<long>, pair_times array<long>")
_CHUNK_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]


def _chunks(path_a: str, path_b: str, entries_of_chunk: int):
    """Chunks of documents: their figures, and their links as (pair of the chunk, times) entries."""
    def chunk(number: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, n_a, n_b, n_groups, n_links, digests, entries, pairs, times = zip(*parts, strict=True)
        times = np.concatenate(times)
        pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
        columns = [np.concatenate(c) for c in (n_a, n_b, n_groups, n_links)]
        row = [[i for part in ids for i in part.to_pylist()], *columns, list(chain.from_iterable(digests)),
               np.concatenate(entries), at.astype(np.int32), times.astype(np.int32), pair,
               np.bincount(at, times, len(pair)).astype(np.int64)]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kind))
                                   for v, kind in zip(row, kinds, strict=True))], names=_CHUNK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        words = GroupTexts(len(loaded(path_a)[1]), len(loaded(path_b)[1]))
        parts, held = [], 0
        for ids, texts in _slices(batches):
            x = Aligned(texts, path_a, path_b)
            first = x.first_link
            document = np.repeat(np.arange(len(texts)), np.diff(first))
            n_a, pairs = len(x.size_a), len(x.size_a) * len(x.size_b)
            entry, times = np.unique(document * pairs + x.ids_b[x.link_b] * n_a + x.ids_a[x.link_a], return_counts=True)
            document, code = entry // pairs, entry % pairs
            parts.append((ids, np.diff(x.first_a), np.diff(x.first_b), x.documents(x.group_end_a, x.first_a),
                          np.diff(first), words.digests(x), np.bincount(document, minlength=len(texts)),
                          code // n_a << 31 | code % n_a, times))
            held += len(entry)
            if held >= entries_of_chunk:
                yield chunk(number, parts)
                number, parts, held = number + 1, [], 0
        if parts:
            yield chunk(number, parts)
    return run


_COUNTED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a chunk with the counts of their links."""
    names = [c.split()[0] for c in _COUNTED.split(", ")]
    for batch in batches:
        for k in range(batch.num_rows):
            ids, n_a, n_b, n_groups, n_links, digest, entries, at, times, counts, best = (
                c[k].values if c[k].is_valid else pa.array([], c.type.value_type) for c in batch.columns)
            at, times = at.to_numpy(), times.to_numpy().astype(np.int64)
            counts = counts.to_numpy(zero_copy_only=False).astype(np.int64)
            best = best.to_numpy(zero_copy_only=False).astype(bool)
            first = np.concatenate(([0], np.cumsum(entries.to_numpy())))
            sums = [np.concatenate(([0], np.cumsum(v))) for v in (times * best[at], times * counts[at])]
            n_best, count_sum = (s[first[1:]] - s[first[:-1]] for s in sums)
            yield pa.RecordBatch.from_arrays([ids, n_a, n_b, n_groups, n_links, pa.array(n_best), pa.array(count_sum),
                                              digest], names=names)


def pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of each chunk (chunk, number in it, pair), and how often each pair is linked in all and
    whether no other pair of its B id is linked more often."""
    pairs = chunks.select("chunk", F.explode(F.arrays_zip("pair", "pair_times")).alias("p")).select(
        "chunk", F.col("p.pair").alias("pair"), F.col("p.pair_times").alias("times"))
    counts = stored(pairs.groupBy("pair").agg(F.sum("times").alias("count")), "pairs")
    b_id = F.shiftright("pair", 31).alias("b")
    highest = counts.groupBy(b_id).agg(F.max("count").alias("highest"))  # a row for each B id
    best = counts.select("*", b_id).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    return pairs.select("chunk", "pair"), stored(best, "pair-counts")


def link_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                entries_of_chunk: int = CHUNK_ENTRIES) -> DataFrame:
    """For each document its numbers of tokens, groups and links, and over its links: how many are of a pair
    linked as often as any of the same B id in the corpus, and the sum of the pairs' counts."""
    chunks = stored(_texts(docs, id_col, text_col).mapInArrow(_chunks(path_a, path_b, entries_of_chunk), _CHUNK),
                    "chunks", compression="zstd")
    pairs, counts = pair_counts(chunks)
    # the pairs of a chunk are in order, so the sorted answers stand beside them
    answers = pairs.join(counts, "pair").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("pair", "count", "best"))).alias("answer"))
    answers = answers.select("chunk", F.col("answer.count").alias("counts"), F.col("answer.best").alias("best"))
    both = chunks.drop("pair", "pair_times").join(answers, "chunk", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "entries", "at", "times", "counts", "best")
    return both.mapInArrow(_count, _COUNTED)
