"""Panel choice (X3): of informative SNPs, those that no kept neighbour already tells.

``pruned_panel`` goes through a map's informative SNPs in order and drops one whose squared
correlation with a kept SNP among the ``window`` before it is above ``max_r2``.

Sample rows are cut into ranges of SNPs and transposed on the way, two bits a call and some samples to a row: a group has one
range, with the window beyond it, for one chunk of samples.  Ranges are taken in passes, so that what a pass shuffles is bounded.  It gives the sums of each pair of SNPs inside the window, which Spark adds
over chunks.  Only pairs above the limit are left for the rule itself, which streams over a map's
pairs in order and remembers one window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators import popgen, samplerows
from genospark.session import stored

#: Samples of a chunk (about: they are dealt in turn), so that a group is a few megabytes.
CHUNK = 4096
#: Samples of a shuffled row, and bytes that one pass shuffles, about.
TOGETHER, PASS_BYTES = 64, 1 << 30
_SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def informative_positions(freqs: DataFrame) -> dict[str, np.ndarray]:
    """Sorted positions of the informative SNPs of each map: four bytes for each SNP of a registered map."""
    rows = freqs.where("informative").select("map_name", F.col("pos").cast("int").alias("pos")).toArrow().to_pandas()
    return {name: np.sort(mine["pos"].to_numpy()) for name, mine in rows.groupby("map_name")}


def _ranges(positions, window: int, chunks: int, first: int, end: int):
    """Cut samples' rows into the ranges from ``first`` to ``end`` of informative SNPs, each with the window beyond it; a row
    has some samples of a map, four calls to a byte."""
    size = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()  # whichever samples a chunk has, they are added up in the end
        held: dict[str, list[bytes]] = {}

        def cut(name: str) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            at, rows = positions.value[name], held.pop(name)
            ranges = range(first, min(end, -(-len(at) // size)))
            if ranges:
                calls = np.full((len(rows), min(len(at), end * size + window) - first * size), 3, np.uint8)
                for k, codes in enumerate(rows):
                    calls[k] = np.minimum(popgen.padded(codes, int(at[-1]) + 1)[at[first * size:end * size + window]], 3)
                parts = [_quarters(calls[:, lo:lo + size + window]) for lo in range(0, size * len(ranges), size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()), pa.array(list(ranges), pa.int32()), pa.array([turn % chunks] * len(parts), pa.int64()),
                     pa.array([len(rows)] * len(parts), pa.int32()), pa.array(parts, pa.binary())], names=["map_name", "range", "chunk", "samples", "codes"])
            turn += 1

        for batch in batches:
            for name, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name in positions.value:
                    held.setdefault(name, []).append(codes)
                    if len(held[name]) >= min(TOGETHER, CHUNK):
                        yield from cut(name)
        for name in list(held):
            yield from cut(name)
    return run


def _quarters(calls: np.ndarray) -> bytes:
    """Calls of 0 to 3, four to a byte."""
    flat = np.zeros(-(-calls.size // 4) * 4, np.uint8)
    flat[:calls.size] = calls.ravel()
    return (flat[0::4] | flat[1::4] << 2 | flat[2::4] << 4 | flat[3::4] << 6).tobytes()


def _calls(quarters: bytes, n: int) -> np.ndarray:
    q = np.frombuffer(quarters, np.uint8)
    return np.stack([q & 3, q >> 2 & 3, q >> 4 & 3, q >> 6], axis=1).ravel()[:n]


def _pair_sums(positions, window: int):
    """Sums over a chunk's samples with both calls, for each pair of SNPs that starts in the range."""
    size = 4 * window

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        start = key[1].as_py() * size
        width = min(len(positions.value[key[0].as_py()]) - start, size + window)
        first, total = min(size, width), None
        a, b = np.nonzero(np.triu(np.tri(first, width, window, dtype=bool), 1))
        for n, codes in zip(rows["samples"].to_pylist(), rows["codes"].to_pylist(), strict=True):
            x = _calls(codes, n * width).reshape(n, width)
            known = (x < 3).astype(np.float32)
            x = np.where(x < 3, x, 0).astype(np.float32)  # sums of whole numbers, exact up to 2^24
            ka, xa = known[:, :first].T, x[:, :first].T
            sums = np.stack([s[a, b] for s in (ka @ known, xa @ known, ka @ x, (xa * xa) @ known, ka @ (x * x), xa @ x)]).astype(np.int64)
            total = sums if total is None else total + sums
        return pa.table({"map_name": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(a + start, pa.int32()),
                         "b": pa.array(b + start, pa.int32()), **dict(zip(_SUMS, map(pa.array, total), strict=True))})
    return run


def linked_pairs(cells: DataFrame, positions: dict[str, np.ndarray], window: int, max_r2: float) -> DataFrame:
    """(map_name, a, b): informative SNPs, by rank, at most ``window`` apart whose squared correlation is above ``max_r2``."""
    rows = popgen.genotypes(cells) if popgen.is_rows(cells) else stored(popgen.genotypes(cells), "packed-genotypes")
    counts = {r.map_name: r["count"] for r in popgen.called_samples(cells).groupBy("map_name").count().collect()}  # a row for each map
    chunks = -(-max(counts.values(), default=1) // CHUNK)
    held = cells.sparkSession.sparkContext.broadcast(positions)
    # bytes of a range: its calls, and a chunk's sums of each of its pairs
    size = 4 * window
    of_range = sum(counts.values()) * 5 * window // 4 + chunks * size * window * 64
    each = max(1, PASS_BYTES // of_range)
    most = max((-(-len(at) // size) for at in positions.values()), default=1)
    found = []
    for first in range(0, most, each):
        parts = rows.select("map_name", "codes").mapInArrow(
            _ranges(held, window, chunks, first, first + each), "map_name string, range int, chunk long, samples int, codes binary")
        sums = parts.groupBy("map_name", "range", "chunk").applyInArrow(
            _pair_sums(held, window), "map_name string, a int, b int, " + ", ".join(f"{s} long" for s in _SUMS))
        total = sums.groupBy("map_name", "a", "b").agg(*[F.sum(s).alias(s) for s in _SUMS])
        cov = (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")).cast("double")
        va = (F.col("n") * F.col("saa") - F.col("sa") * F.col("sa")).cast("double")
        vb = (F.col("n") * F.col("sbb") - F.col("sb") * F.col("sb")).cast("double")
        linked = total.where((va > 0) & (vb > 0) & (cov * cov > F.lit(max_r2) * (va * vb))).select("map_name", "a", "b")
        found.append(stored(linked, "linked"))
    return samplerows.union(found)


def _dropped(positions, window: int):
    """The rule on pairs sorted by map, second and first SNP."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = at = None
        gone: dict[int, int] = {}  # dropped within the window: rank -> rank of the kept SNP that tells it
        for batch in batches:
            out: list[tuple[str, int, int]] = []
            for m, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if m != name:
                    name, at, gone = m, positions.value[m], {}
                if a in gone or b in gone:
                    continue
                if len(gone) > 2 * window:
                    gone = {r: by for r, by in gone.items() if r >= b - window}
                gone[b] = a
                out.append((m, int(at[b]), int(at[a])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.int32())], names=["map_name", "pos", "told_by"])
    return run


def pruned_panel(cells: DataFrame, freqs: DataFrame, window: int = 50, max_r2: float = 0.2) -> DataFrame:
    """(map_name, pos, snp_name, maf, kept, told_by): the informative SNPs of ``allele_frequencies``.

    ``told_by`` is the position of the first kept SNP within the ``window`` informative SNPs before it that has a squared
    correlation above ``max_r2`` with a dropped one, over samples called at both; null for kept SNPs.  A pair
    where either SNP is constant among these samples has none.
    """
    positions = informative_positions(freqs)
    panel = freqs.where("informative").select("map_name", "pos", "snp_name", "maf")
    pairs = linked_pairs(cells, positions, window, max_r2)
    held = cells.sparkSession.sparkContext.broadcast(positions)
    # a map's pairs are at most its SNPs times the window, and are streamed
    dropped = (pairs.repartition("map_name").sortWithinPartitions("map_name", "b", "a")
               .mapInArrow(_dropped(held, window), "map_name string, pos int, told_by int"))
    return panel.join(dropped, ["map_name", "pos"], "left").select(
        "map_name", "pos", "snp_name", "maf", F.col("told_by").isNull().alias("kept"), "told_by")
