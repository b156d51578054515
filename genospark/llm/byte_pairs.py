"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The bytes of a piece of text become Latin-1 characters, so that one Aho-Corasick
automaton over all tokens finds every token in it.  The ids are then found from left
to right: take the longest token at the place reached; if it cannot stand beside the
token before, take its next shorter prefix that is a token; if none is left, the place
is dead, and the token before is replaced the same way.

Two tokens can stand side by side if merging their joined bytes gives just these two.
That is exact for any ranks: merges inside a span depend on the span alone, so a
sequence is the result of the merges if and only if each pair of neighbours is the
result for its own bytes (else the first merge across a border would be the first
across it in the pair alone too).  Hence a prefix of the piece is reached by one
sequence at most, a dead place stays dead, and the work is linear in the piece.
Pairs are remembered, and so are pieces: texts repeat them.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows that
repeat an id or have none are encoded one by one; other columns are not read unless
named in ``keep``; without documents there are no rows.  A vocabulary lacks no single
byte, or a text with that byte raises ``ValueError``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T

#: Entries of a memo; beyond, the older half goes.
REMEMBERED = 500_000
#: Longer pieces are not remembered.
LONGEST_REMEMBERED = 64
#: Characters of a text whose pieces are held at once, and pieces of a longer one.
WHOLE_CHARS, HELD_PIECES = 1 << 20, 1 << 16


class Memo(dict):
    """Values by key, computed where missing; the older half goes when there are too many."""

    def __init__(self, compute, limit: int = REMEMBERED):
        super().__init__()
        self.compute, self.limit, self.older = compute, max(limit // 2, 1), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class BytePairs:
    """Encoder and decoder of a vocabulary of byte strings with ranks, which are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        most = max(ranks.values(), default=-1) + 1
        self.token: list[bytes | None] = [None] * most
        self.size = np.zeros(most, np.int64)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.token[rank] = token
            self.size[rank] = len(token)
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.starts = np.concatenate(([0], np.cumsum(self.size)))
        self.flat = np.frombuffer(b"".join(t or b"" for t in self.token), np.uint8)
        self.sizes = self.size.tolist()
        self.shorter = [self._shorter(t) if t else -1 for t in self.token]
        self.side_by_side = Memo(self._side_by_side)
        self.stands_alone = Memo(lambda rank: self._merged(self.token[rank]) == [rank])
        self.packed = Memo(self._packed)

    def _shorter(self, token: bytes) -> int:
        """The longest token that is a shorter prefix of the token, or -1."""
        ranks = self.ranks
        return next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)

    def _merged(self, piece: bytes) -> list[int]:
        """Ids by the merges themselves, lowest rank first, of equal ones the leftmost; for a few bytes."""
        get, never = self.ranks.get, len(self.token)
        cut = list(range(len(piece) + 1))  # where the parts begin, and the end
        pairs = [get(piece[k:k + 2], never) for k in range(len(piece) - 1)]
        while pairs and (rank := min(pairs)) < never:
            k = pairs.index(rank)
            del cut[k + 1], pairs[k]
            if k < len(pairs):
                pairs[k] = get(piece[cut[k]:cut[k + 2]], never)
            if k:
                pairs[k - 1] = get(piece[cut[k - 1]:cut[k + 1]], never)
        return [self.ranks[piece[i:j]] for i, j in pairwise(cut)]

    def _side_by_side(self, pair: tuple[int, int]) -> bool:
        left, right = pair
        return self._merged(self.token[left] + self.token[right]) == [left, right]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece.  A piece that is a token is that token, whatever the merges give."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, (rank, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # later ones are longer
        size, beside, alone, shorter = self.sizes, self.side_by_side, self.stands_alone, self.shorter
        ids, at, dead, n = [], 0, bytearray(len(piece) + 1), len(piece)
        token = longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if not dead[end] and (beside[ids[-1], token] if ids else alone[token]):
                    break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif ids:
                dead[at] = 1
                at -= size[ids[-1]]
                token = shorter[ids.pop()]
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return ids

    def _packed(self, piece: str) -> bytes:
        return np.asarray(self.encode_piece(piece.encode()), "<u4").tobytes()

    def _pack(self, piece: str) -> bytes:
        return self.packed[piece] if len(piece) <= LONGEST_REMEMBERED else self._packed(piece)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(text) <= WHOLE_CHARS:
            return b"".join(map(self._pack, self.pattern.findall(text)))
        pieces, out = (m.group() for m in self.pattern.finditer(text)), []
        while held := list(islice(pieces, HELD_PIECES)):
            out.append(b"".join(map(self._pack, held)))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        ids = np.asarray(ids, np.int64)
        return self.flat[T.ranges(self.starts[ids], self.size[ids])].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a base64 string and a rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


_loaded: dict[tuple[str, str], BytePairs] = {}


def loaded(path: str, pattern: str) -> BytePairs:
    """The vocabulary of a rank file, read once a worker."""
    key = path, pattern
    return _loaded.get(key) or _loaded.setdefault(key, BytePairs(read_ranks(path), pattern))


def _slices(column: pa.Array) -> Iterator[pa.Array]:
    """Parts of a string or binary column whose bytes are bounded, but for a single longer value."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), np.int64)
    for i, j in T.slices(np.concatenate(([0], np.cumsum(size)))):
        yield i, column.slice(i, j - i)


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(path, pattern)
        for batch in batches:
            for i, texts in _slices(batch.column(0)):
                ids = [vocabulary.encode(t or "") for t in texts.to_pylist()]
                rest = [c.slice(i, len(ids)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.binary())],
                                                 names=[*batch.schema.names[1:], "ids"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(path, pattern)
        for batch in batches:
            for i, part in _slices(batch.column(0)):
                texts = [vocabulary.decode(np.frombuffer(v or b"", "<u4")) for v in part.to_pylist()]
                rest = [c.slice(i, len(texts)) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.binary())],
                                                 names=[*batch.schema.names[1:], "decoded"])
    return run


def _fields(frame: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` and ``ids``: the ids of each whole text as little-endian unsigned
    32-bit integers in a binary column.  ``path`` names a rank file, the same on every machine."""
    T.bounded_batches(docs.sparkSession)
    kept = docs.select(*keep)
    return docs.select(F.col(text_col).cast("string").alias("__text"), *keep).mapInArrow(
        _encode(path, pattern), f"{_fields(kept)}ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes of its ``ids`` in a further column ``decoded``."""
    T.bounded_batches(encoded.sparkSession)
    return encoded.select(F.col("ids").alias("__ids"), "*").mapInArrow(
        _decode(path, pattern), f"{_fields(encoded)}decoded binary")
