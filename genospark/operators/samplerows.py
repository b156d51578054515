"""Calls of many samples on dense maps, as one row of bits a sample.

A row has the numbers of its 64-position blocks (``first``, and ``at`` where they are not consecutive) and for each block
a long in ``lo``, ``hi`` and ``seen``: of a position, ``lo`` and ``hi`` are 0, 0 for BB, 1, 0 for AB, 0, 1 for AA and 1, 1 for no
call.  A position with several calls of one upload is marked in ``odd`` (null where no position is), and ``lo``, ``hi`` then say
which: 0, 0 for BB and AB, 1, 0 for BB and AA, 0, 1 for AB and AA, 1, 1 for all three.  So a call takes two bits, of one
sample on one map: a row is bounded by the chip.

Rows are made where the calls lie, without a shuffle.  Only if a sample's calls come from several uploads or lie
apart are all rows added up behind one, and stored again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.session import stored

BLOCK = 64
#: Calls that are packed at once, and blocks of an Arrow batch.
PACKED_CALLS, BATCH_BLOCKS = 1 << 20, 1 << 15
#: Bytes of an Arrow batch of rows.
BATCH_BYTES = 1 << 23
#: Bytes of rows that one pass of ``by_key`` shuffles.
PASS_BYTES = 1 << 30
PLANES = ["first", "at", "lo", "hi", "odd"]
_FIELDS = "n_called long, first int, at binary, lo binary, hi binary, odd binary, seen binary"
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session: the packed calls of one sample can be a megabyte."""
    if int(spark.conf.get(_BYTES).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BYTES, BATCH_BYTES)


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Arrow batches are bounded by their number of rows alone: for calls, whose rows are short.  A bound of bytes makes
    Spark add up its buffers after each row, which takes longer than all else that is done to a call."""
    before = spark.conf.get(_BYTES)
    spark.conf.set(_BYTES, (1 << 31) - 1)
    try:
        yield
    finally:
        spark.conf.set(_BYTES, before)


def is_rows(cells: DataFrame) -> bool:
    return "lo" in cells.columns


def _starts(key: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])


def _binary(data: np.ndarray, lengths: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """Consecutive pieces of ``data`` as binary; null where not ``known``."""
    size = np.concatenate([[0], np.cumsum(lengths * data.itemsize)]).astype(np.int32)
    valid = None if known is None else pa.py_buffer(np.packbits(known, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(lengths), [valid, pa.py_buffer(size.tobytes()), pa.py_buffer(data.tobytes())])


def _rows(group: np.ndarray, block: np.ndarray, b: list[np.ndarray], seen: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The group of each row and its columns (``_FIELDS``), of blocks that are sorted by group and number."""
    at = _starts(group)
    size = np.diff(np.append(at, len(group)))
    b0, b1, b2 = b
    several, none = (b0 & b1) | (b0 & b2) | (b1 & b2), ~(b0 | b1 | b2)
    lo, hi = (~several & (b1 | none)) | (several & b0 & b2), (~several & (b2 | none)) | (several & b1 & b2)
    first = block[at]
    gaps = block[at + size - 1] - first + 1 != size
    odd = np.bitwise_or.reduceat(several, at) != 0
    called = np.add.reduceat(np.bitwise_count(~none).astype(np.int64), at)
    inside = np.repeat(gaps, size), np.repeat(odd, size)
    return group[at], [
        pa.array(called), pa.array(first.astype(np.int32)), _binary(block[inside[0]].astype("<i4"), np.where(gaps, size, 0), gaps),
        _binary(lo, size), _binary(hi, size), _binary(several[inside[1]], np.where(odd, size, 0), odd), _binary(seen, size)]


class _Calls:
    """Some calls with their (map, sample, upload) as numbers."""

    def __init__(self, table: pa.Table):
        self.table, self.values, group = table, [], np.zeros(len(table), np.int64)
        for name in ("map_name", "sample_id", "nume_cari"):
            column = table[name].combine_chunks()
            column = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).dictionary_encode(null_encoding="encode")
            group = group * len(column.dictionary) + column.indices.to_numpy()
            self.values.append(column.dictionary)
            if group.max(initial=0) >= 1 << 31:
                break
        else:
            self.group = group
            return
        # many of each: numbered by what is there
        keys = table.select(["map_name", "sample_id", "nume_cari"]).to_pylist()
        index: dict[tuple, int] = {}
        self.group = np.array([index.setdefault(tuple(k.values()), len(index)) for k in keys], np.int64)
        self.values = list(index)

    def keys(self, group: np.ndarray) -> list[pa.Array]:
        types = [self.table.schema.field(k).type for k in ("map_name", "sample_id", "nume_cari")]
        if isinstance(self.values[0], tuple):
            return [pa.array([self.values[g][k] for g in group], t) for k, t in enumerate(types)]
        out = []
        for values in reversed(self.values):
            out.append(values.take(pa.array(group % len(values))))
            group = group // len(values)
        return out[::-1]

    def last(self) -> int:
        """Where the last run of calls of one group starts."""
        other = np.flatnonzero(self.group != self.group[-1])
        return int(other[-1]) + 1 if len(other) else 0

    def packed(self, end: int) -> pa.RecordBatch:
        """Rows of the calls before ``end``."""
        def numbers(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
            column = self.table[name].slice(0, end).combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            known = np.ones(end, bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
            return (column.fill_null(0) if column.null_count else column).to_numpy().astype(kind, copy=False), known

        group = self.group[:end]
        (pos, placed), (code, coded) = numbers("pos", np.int64), numbers("code", np.int64)
        counts = coded & (numbers("nume_cari", np.int64)[1] if self.table["nume_cari"].null_count else True)
        block = np.where(placed, pos >> 6, -1)
        bit = np.where(placed, np.uint64(1) << (pos & 63).astype(np.uint64), np.uint64(0))
        key = group * (int(block.max()) + 2) + block + 1
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, group, block, bit, code, counts = (x[order] for x in (key, group, block, bit, code, counts))
        at = _starts(key)
        b = [np.bitwise_or.reduceat(np.where((code == k) & counts, bit, np.uint64(0)), at) for k in range(3)]
        of, columns = _rows(group[at], block[at], b, np.bitwise_or.reduceat(bit, at))
        return pa.RecordBatch.from_arrays([*self.keys(of), *columns], names=["map_name", "sample_id", "nume_cari",
                                                                             *(f.split()[0] for f in _FIELDS.split(", "))])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n, enough = [], 0, PACKED_CALLS
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        calls = _Calls(pa.Table.from_batches(held))
        end = calls.last()  # of the last sample more may come
        if end:
            yield calls.packed(end)
        held = calls.table.slice(end).to_batches()
        n -= end
        enough = max(PACKED_CALLS, 2 * n)
    if n:
        yield _Calls(pa.Table.from_batches(held)).packed(n)


def planes(first: int, at: bytes | None, lo: bytes, hi: bytes, odd: bytes | None) -> tuple[np.ndarray, ...]:
    """The numbers of a row's blocks and their bits b0, b1, b2."""
    lo, hi = np.frombuffer(lo, "<u8"), np.frombuffer(hi, "<u8")
    block = np.arange(first, first + len(lo)) if at is None else np.frombuffer(at, "<i4").astype(np.int64)
    b0, b1, b2 = ~(lo | hi), lo & ~hi, hi & ~lo
    if odd is not None:
        odd = np.frombuffer(odd, "<u8")
        b0, b1, b2 = (b0 & ~odd) | (odd & ~b2), (b1 & ~odd) | (odd & ~b1), (b2 & ~odd) | (odd & (lo | hi))
    return block, b0, b1, b2


def shared(one: tuple, other: tuple) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The bits of two rows' ``planes`` in the blocks that both have."""
    (a, *mine), (b, *others) = one, other
    n = min(len(a), len(b))
    if a[0] == b[0] and a[n - 1] == b[n - 1] == a[0] + n - 1:  # no gaps as far as both go, and nothing of one beyond the other's end
        return [x[:n] for x in mine], [x[:n] for x in others]
    _, i, k = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return [x[i] for x in mine], [x[k] for x in others]


def batch_of(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names = [f.split() for f in fields.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)],
                                      names=[n for n, _ in names])


def _blocks(keys: list[str]):
    """Rows of samples as a row for each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = pa.array(np.repeat([k for k, *_ in held], [len(x[1]) for x in held]))
            block, *b = (np.concatenate(x) for x in list(zip(*held, strict=True))[1:])
            return pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(rows) for k in keys), pa.array(block.astype(np.int32), mask=block < 0),
                 *(pa.array(x.view(np.int64)) for x in b)], names=[*keys, "block", "b0", "b1", "b2", "seen"])
        for batch in batches:
            held, n = [], 0
            for k, (*row, seen) in enumerate(zip(*(batch.column(c).to_pylist() for c in (*PLANES, "seen")), strict=True)):
                held.append((k, *planes(*row), np.frombuffer(seen, "<u8")))
                n += len(held[-1][1])
                if n >= BATCH_BLOCKS:
                    yield out()
                    held, n = [], 0
            if held:
                yield out()
    return run


def blocks(rows: DataFrame, *more: str) -> DataFrame:
    """(map_name, sample_id, more, block, b0, b1, b2, seen) of sample rows."""
    bounded_batches(rows.sparkSession)
    keys = ["map_name", "sample_id", *more]
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, *PLANES, "seen").mapInArrow(
        _blocks(keys), kinds + ", block int, b0 long, b1 long, b2 long, seen long")


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        of = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
        fields = batch.column(2).flatten()
        block = fields.field("block").fill_null(-1).to_numpy().astype(np.int64)
        *b, seen = (fields.field(f).to_numpy().view(np.uint64) for f in ("b0", "b1", "b2", "seen"))
        _, columns = _rows(of, block, b, seen)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns],
                                         names=["map_name", "sample_id", *(f.split()[0] for f in _FIELDS.split(", "))])


def sample_rows(cells: DataFrame, latest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``cells`` (nume_cari, sample_id, map_name, pos, code) as a stored table of sample rows.  ``latest`` makes one block
    of blocks by upload, where a sample has several rows."""
    bounded_batches(cells.sparkSession)
    keys = ["map_name", "sample_id", "nume_cari"]
    kinds = ", ".join(f"{k} {cells.schema[k].dataType.simpleString()}" for k in keys)
    with batches_by_rows(cells.sparkSession):
        rows = stored(cells.select(*keys, "pos", "code").mapInArrow(_pack, f"{kinds}, {_FIELDS}"), "sample-rows", "zstd")
    if rows.groupBy("map_name", "sample_id").count().where("count > 1").isEmpty():
        return rows.drop("nume_cari")
    each = latest(blocks(rows, "nume_cari")).groupBy("map_name", "sample_id").agg(
        F.array_sort(F.collect_list(F.struct("block", "b0", "b1", "b2", "seen"))).alias("blocks"))
    return stored(each.mapInArrow(_of_blocks, f"map_name string, sample_id string, {_FIELDS}"), "sample-rows", "zstd")


def by_key(rows: DataFrame, wanted: DataFrame, keys: list[str], run: Callable, fields: str) -> list[DataFrame]:
    """``run`` over the sample rows that each of ``keys`` wants, in passes that the caller stores one after the other.

    ``wanted`` has the keys, ``sample_id``, ``kind`` and further columns (map_name, if it is given, is a key too).  A task has all rows of
    a map and key together, by ``kind``: columns of ``wanted``, map_name and ``PLANES``.  So that the shuffle
    of a pass stays below ``PASS_BYTES``, about, a pass takes a part of the keys."""
    spark = rows.sparkSession
    bounded_batches(spark)
    wanted = stored(wanted, "wanted")
    size = rows.agg(F.avg(F.length("lo") + F.length("hi") + 100)).first()[0] or 0
    passes = max(1, -(-int(wanted.count() * size) // PASS_BYTES))
    on = [c for c in ("map_name", "sample_id") if c in wanted.columns]
    columns = ["map_name", *(c for c in wanted.columns if c != "map_name"), *PLANES]
    together = list(dict.fromkeys(["map_name", *keys]))
    out = []
    for k in range(passes):
        mine = wanted.where(F.pmod(F.xxhash64(*keys), F.lit(passes)) == k) if passes > 1 else wanted
        out.append(rows.where("n_called > 0").join(mine, on).select(*columns).repartition(*together)
                   .sortWithinPartitions(*together, "kind").mapInArrow(run, fields))
    return out


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
