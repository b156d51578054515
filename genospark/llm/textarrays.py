"""Vectorised work on the UTF-8 bytes of whole texts, for use inside Arrow batches.

A text column arrives as one byte buffer with offsets.  Words are found by
looking at bytes alone (every byte of a multi-byte character is 0x80 or more),
and every word gets a 64-bit polynomial hash over prefix sums, so no Python
object is made per word.  Two different words share a 64-bit hash with
probability 2**-64 per pair (random byte table, random odd base).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes handled at once; a longer single text is handled whole.
SLICE_BYTES = 1 << 19

#: Bytes of an Arrow batch between the JVM and a worker.
BATCH_BYTES = 8 << 20
#: The same where a job of many stages keeps its executors' memory: under a power of two, to which the JVM rounds up.
SMALL_BATCH_BYTES = (4 << 20) - (1 << 19)

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes of white space 0x09-0x0D and 0x20.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Letters, digits and all non-ASCII bytes.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + (SLICE_BYTES >> 3))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of one byte array."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        up, self.down = _POWERS.upto(len(data) + 1)
        table = _BYTE[LOWER] if lower else _BYTE
        self.sums = np.zeros(len(data) + 1, np.uint64)
        own = table[data]
        own *= up[:len(data)]
        np.cumsum(own, out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space after each; the offsets of their starts and the end."""
    out = np.insert(data, offsets[1:], 0x20)
    return out, offsets + np.arange(len(offsets))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edge[0::2], edge[1::2]


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, lower: bool = True):
    """Words (runs of ``member`` bytes) of the texts of a slice, in order.

    Returns the 64-bit hash of each word and, for each text, the number of the
    words before it (one more entry than texts).
    """
    text, starts_at = spaced(data, offsets)
    start, end = runs(member[text])
    return SpanHash(text, lower)(start, end), np.searchsorted(start, starts_at)


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the session, so that a task holds little beside one slice."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > most:
        spark.conf.set(key, most)


def give_back() -> None:
    """Return the memory that is free in this process to the system, and what is cheap to make again."""
    _POWERS.up = _POWERS.down = np.ones(1, np.uint64)
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def releases(run: Callable) -> Callable:
    """The task ``run`` of Arrow batches, which gives its free memory back at its end: workers are used again, and
    what one stage left in them would stand beside the next stage's needs."""
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return task


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted values and how often each occurs."""
    return np.unique(values, return_counts=True)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated index ranges start .. start + count."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total) + shift
