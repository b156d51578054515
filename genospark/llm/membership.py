"""A bitmap that lets tasks drop rows before a shuffle.

The bits are set by the tasks, joined by part in Spark and reach the driver packed: 2**MOST_BITS / 8 bytes
(2 MB) at most, whatever the number of keys.  Beyond some millions of keys more rows pass than are wanted, up to
all of them: results do not change, but the shuffle behind it grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of the largest bitmap.
MOST_BITS = 24
#: Bytes of a part of it.
PART = 512


class Filter:
    """Keys (64-bit hashes) that may be wanted: a bitmap over their leading bits."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]] = ()):
        self.bits = bits
        self.map = np.zeros(1 << bits - 3, np.uint8)
        for part, own in parts:
            self.map[part * PART:(part + 1) * PART] = np.frombuffer(own, np.uint8)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.int64(64 - self.bits)) + (1 << self.bits - 1)

    def add(self, keys: np.ndarray) -> None:
        at = self._at(keys)
        np.bitwise_or.at(self.map, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Which of the signed 64-bit keys may be wanted."""
        at = self._at(keys)
        return (self.map[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def parts(self) -> pa.RecordBatch:
        """The parts with any bit."""
        rows = self.map.reshape(-1, PART)
        some = np.flatnonzero(rows.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)),
                                           pa.array([rows[k].tobytes() for k in some], pa.binary())], names=["part", "map"])


def bits_for(count: int) -> int:
    return min(MOST_BITS, max(12, count.bit_length() + 4))


def _set(bits: int, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(bits)
        for batch in batches:
            for keys in ([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0)] if packed
                         else [batch.column(0).to_numpy(zero_copy_only=False)]):
                own.add(keys)
        yield own.parts()
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, own in zip(*batch.to_pydict().values(), strict=True):
            own = np.frombuffer(own, np.uint8)
            total[part] = total[part] | own if part in total else own
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["part", "map"])


def _collected(keys: DataFrame, count: int, packed: bool) -> Filter:
    bits = bits_for(count)
    schema = "part int, map binary"
    rows = keys.mapInArrow(_set(bits, packed), schema).repartition("part").mapInArrow(_joined, schema).collect()
    return Filter(bits, [tuple(r) for r in rows])


def packed_filter(keys: DataFrame, count: int) -> Filter:
    """The filter of ``count`` distinct keys that come as arrays of int64 in the binary first column."""
    return _collected(keys.select(keys.columns[0]), count, True)


def wanted(keys: DataFrame, count: int) -> Filter:
    """The filter of the distinct keys in the first column, ``count`` of them."""
    return _collected(keys.select(keys.columns[0]), count, False)
