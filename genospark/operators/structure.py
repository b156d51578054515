"""Population substructure (X9): principal components of genotypes, and likelihoods that know of it (X6, X7).

``principal_components`` finds the leading axes of the standardised genotypes by subspace iteration.  A
sample's calls are one packed row; a round multiplies each row by the axes and back, so what a task gives out and what the
driver holds is SNPs of a map times axes, whatever the number of samples.  No pair of
samples is compared.

Where samples come from known groups, wholly or in shares, ``group_frequencies`` estimates the allele frequencies of
each group and a sample's own frequencies are their mixture by its shares.  ``group_exclusion`` and
``group_likelihood_ratios`` are exclusion probability and likelihood ratio with these in place of the frequencies over all samples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators import popgen, samplerows
from genospark.session import shuffles_deleted, stored

#: Axes beyond those asked for; they speed up convergence.
SPARE_AXES = 8
#: SNPs of one row of partial sums.
SNP_BLOCK = 1024
#: Genotypes multiplied at once, in whole rows: 32 MB as doubles.
CELLS = 1 << 22
#: Group frequencies (groups times SNPs, over all maps) that may be broadcast: half a gigabyte.
MOST_FREQUENCIES = 1 << 26


def _standardised(codes: list[bytes], p: np.ndarray) -> np.ndarray:
    """(code - 2p) / sqrt(2pq), 0 where a call is missing or the SNP has one allele."""
    x = np.stack([popgen.padded(c, len(p)) for c in codes])
    spread = 2 * p * (1 - p)
    known = spread > 0  # NaN where no call is
    scale = np.where(known, 1 / np.sqrt(np.where(known, spread, 1)), 0)
    return np.where((x < 3) & known, (x - np.where(known, 2 * p, 0)) * scale, 0)


def _products(frequencies, axes):
    """Partial sums of x'(x V) and of x'x over a task's samples, by map and block of SNPs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        squares: dict[str, float] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in sorted(set(names) & set(axes.value)):
                at, v = np.flatnonzero(names == name), axes.value[name]
                step = max(1, CELLS // len(v))
                for lo in range(0, len(at), step):
                    codes = batch.column(1).take(pa.array(at[lo:lo + step])).to_pylist()
                    x = _standardised(codes, frequencies.value[name])
                    sums[name] = sums.get(name, 0) + x.T @ (x @ v)
                    squares[name] = squares.get(name, 0.0) + float((x * x).sum())
        for name, total in sums.items():
            for block, lo in enumerate(range(0, len(total), SNP_BLOCK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int32()), pa.array([squares[name] if not block else 0.0]),
                     pa.array([total[lo:lo + SNP_BLOCK].tobytes()], pa.binary())],
                    names=["map_name", "block", "squares", "sums"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by map and block of rows sorted by them: one block is held at a time."""
    key, total, squares = None, None, 0.0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([squares]),
                                           pa.array([total.tobytes()], pa.binary())],
                                          names=["map_name", "block", "squares", "sums"])
    for batch in batches:
        for name, block, square, part in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
            if key is not None and key != (name, block):
                yield out()
            if key != (name, block):
                key, total, squares = (name, block), np.zeros(len(part) // 8), 0.0
            total += np.frombuffer(part)
            squares += square
    if key is not None:
        yield out()


_SUMS = "map_name string, block int, squares double, sums binary"


def _scores(frequencies, axes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids, scores = [], [], []
            for name, sample, codes in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                if name in axes.value:
                    x = _standardised([codes], frequencies.value[name])
                    names.append(name)
                    ids.append(sample)
                    scores.append((x @ axes.value[name])[0].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(ids, pa.string()), pa.array(scores, pa.list_(pa.float64()))],
                names=["map_name", "sample_id", "scores"])
    return run


class Components:
    """``scores``: (map_name, sample_id, scores), a sample's coordinates on the axes; ``axes``: (map_name, component,
    variance, share, residual) with the variance along an axis, its share of all, and how far the axis still moves
    (0: not at all); ``rounds``: passes over the genotypes."""

    def __init__(self, scores: DataFrame, axes: DataFrame, rounds: int):
        self.scores, self.axes, self.rounds = scores, axes, rounds


def principal_components(cells: DataFrame, freqs: DataFrame, k: int = 4, tolerance: float = 1e-6,
                         max_rounds: int = 60, seed: int = 1) -> Components:
    """The ``k`` leading principal components of each map's samples.

    Missing calls count as the mean and SNPs with one allele as nothing.  A map with fewer than ``k`` such SNPs or
    samples has fewer components.  Of an axis and its opposite the one whose largest loading is positive holds.  Rounds go on
    until all ``k`` axes move less than ``tolerance`` of the first variance, or for ``max_rounds``.

    The driver holds SNPs times ``k + SPARE_AXES`` doubles of each map, which are broadcast each round.
    """
    spark = cells.sparkSession
    rows = stored(popgen.genotypes(cells), "packed-genotypes", "zstd")
    by_map = popgen.frequencies_by_map(freqs)
    frequencies = spark.sparkContext.broadcast(by_map)
    random = np.random.default_rng(seed)
    vectors = {}
    for name in sorted(by_map):
        p = by_map[name]
        useful = (p > 0) & (p < 1)
        if useful.any():
            start = random.standard_normal((len(p), min(k + SPARE_AXES, int(useful.sum())))) * useful[:, None]
            vectors[name] = np.linalg.qr(start)[0]
    found: dict[str, list[tuple[float, float, float]]] = {}
    done = 0
    while vectors and done < max_rounds:
        axes = spark.sparkContext.broadcast(vectors)
        parts = rows.select("map_name", "codes").mapInArrow(_products(frequencies, axes), _SUMS).withColumn(
            "task", F.spark_partition_id())
        # summed in the order of tasks, so that a repeated round gives the same digits
        with shuffles_deleted(spark):
            summed = (parts.repartition("map_name", "block").sortWithinPartitions("map_name", "block", "task")
                      .select("map_name", "block", "squares", "sums").mapInArrow(_added, _SUMS)).collect()
        axes.unpersist()
        done += 1
        products: dict[str, dict[int, bytes]] = {}
        squares: dict[str, float] = {}
        for r in summed:
            products.setdefault(r.map_name, {})[r.block] = r.sums
            squares[r.map_name] = squares.get(r.map_name, 0.0) + r.squares
        settled = True
        for name, blocks in products.items():
            v = vectors[name]
            z = np.frombuffer(b"".join(blocks[b] for b in sorted(blocks))).reshape(v.shape)
            values, turn = np.linalg.eigh(v.T @ z)
            turn, values = turn[:, ::-1], values[::-1]
            v, z = v @ turn, z @ turn
            real = values > 1e-9 * max(values[0], 1e-300)
            residuals = np.linalg.norm(z - v * values, axis=0) / max(values[0], 1e-300)
            found[name] = [(float(a), float(a / squares[name]), float(r))
                           for a, r, ok in zip(values[:k], residuals[:k], real[:k], strict=True) if ok]
            if any(r > tolerance for _, _, r in found[name]) and done < max_rounds:
                settled = False
                vectors[name] = np.linalg.qr(z)[0]
            else:
                vectors[name] = v
        if settled:
            break
    leading = {}
    for name, values in found.items():
        v = vectors[name][:, :len(values)]
        leading[name] = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1, 1)
    scores = rows.select("map_name", "sample_id", "codes").mapInArrow(
        _scores(frequencies, spark.sparkContext.broadcast(leading)), "map_name string, sample_id string, scores array<double>")
    axes = spark.createDataFrame([(name, j + 1, *row) for name in sorted(found) for j, row in enumerate(found[name])],
                                 "map_name string, component int, variance double, share double, residual double")
    return Components(scores, axes, done)


def group_frequencies(cells: DataFrame, shares: DataFrame) -> DataFrame:
    """(map_name, pos, grp, weight, p): frequency of A in each group, samples weighed by their ``shares``
    (sample_id, grp, share); ``weight`` is the summed share of samples with a call.  Nulls and shares of 0 count for nothing."""
    known = shares.where("share > 0 AND grp IS NOT NULL").select("sample_id", F.col("grp").cast("string"), F.col("share").cast("double"))
    if popgen.is_rows(cells):
        rows = samplerows.blocks(cells.where("n_called > 0").join(known, "sample_id"), "grp", "share").where("b0 | b1 | b2 <> 0")
    else:
        rows = popgen.bitsets(cells).join(known, "sample_id")
    rows = rows.drop("sample_id", "seen")

    def part(batch: pa.RecordBatch, group: np.ndarray, n: int) -> np.ndarray:
        b0, b1, b2 = (popgen.bits_of(batch.column(b)) for b in ("b0", "b1", "b2"))
        share = batch.column("share").to_numpy()[:, None, None]
        return popgen.summed(np.stack([b0 | b1 | b2, b1 + 2 * b2], axis=2) * share, group, n, np.float64)

    def finish(sums: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        at = np.flatnonzero(sums[:, 0])
        return at, [sums[at, 0], sums[at, 1] / (2 * sums[at, 0])]
    found = popgen.block_sums(rows, ["map_name", "grp", "block"], np.float64, 2, part, finish,
                              "map_name string, grp string, pos int, weight double, p double")
    return found.select("map_name", "pos", "grp", "weight", "p")


def _matrices(groups: DataFrame) -> dict[str, tuple[list[str], np.ndarray]]:
    """By map: its groups and their frequencies by position, NaN where unknown (eight bytes for each SNP and group)."""
    rows = groups.select("map_name", F.col("pos").cast("int"), F.col("grp").cast("string"), "p").toArrow().to_pandas()
    out = {}
    for name, mine in rows.groupby("map_name"):
        names = sorted(mine["grp"].unique())
        p = np.full((len(names), int(mine["pos"].max()) + 1), np.nan)
        p[np.searchsorted(names, mine["grp"].to_numpy(object)), mine["pos"]] = mine["p"]
        out[name] = names, p
    return out


def mixture(names: list[str], p: np.ndarray, shares: list[tuple[str, float]]) -> np.ndarray:
    """A sample's own frequencies: the mean of its groups' by share; NaN unless each of its groups has one."""
    own, total = np.zeros(p.shape[1]), 0.0
    for group, share in sorted(shares):
        own = own + share * (p[names.index(group)] if group in names else np.nan)
        total += share
    return own / total


def _shares_by_sample(shares: DataFrame) -> DataFrame:
    """(sample_id, mix): a row holds one sample's groups."""
    return (shares.where("share > 0 AND grp IS NOT NULL").groupBy("sample_id")
            .agg(F.collect_list(F.struct(F.col("grp").cast("string").alias("grp"), F.col("share").cast("double").alias("share")))
                 .alias("mix")))


def _for_samples(rows: DataFrame, groups: DataFrame, keep: list[str], value: str,
                 compute: Callable[[np.ndarray, dict], tuple[int, float]]) -> DataFrame:
    """(map_name, ``keep``, n_snps, ``value``) by ``compute`` on the sample's own frequencies and the row.

    Raises ValueError for more than ``MOST_FREQUENCIES`` of them: then fewer maps have to be given at once."""
    size = groups.count()
    if size > MOST_FREQUENCIES:
        raise ValueError(f"{size} group frequencies, at most {MOST_FREQUENCIES} can be broadcast: give fewer maps at once")
    matrices = rows.sparkSession.sparkContext.broadcast(_matrices(groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums = [], []
            for row in batch.to_pylist():
                p = mixture(*matrices.value[row["map_name"]], [(m["grp"], m["share"]) for m in row["mix"]])
                p[~((p > 0) & (p < 1))] = np.nan
                n, total = compute(p, row)
                sizes.append(n)
                sums.append(total)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("map_name", *keep)), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                names=["map_name", *keep, "n_snps", value])
    schema = ", ".join(f"{c} string" for c in ("map_name", *keep)) + f", n_snps long, {value} double"
    return rows.mapInArrow(run, schema).where("n_snps > 0")


def group_exclusion(cells: DataFrame, shares: DataFrame) -> DataFrame:
    """(map_name, sample_id, n_snps, pe_combined): single-parent exclusion probability at the sample's own frequencies,
    over the SNPs that have two alleles there; for genotyped samples with shares."""
    def combined(p: np.ndarray, row: dict) -> tuple[int, float]:
        p = p[~np.isnan(p)]
        return len(p), float(1 - np.exp(np.log(1 - 2 * p * p * (1 - p) * (1 - p)).sum()))

    cells = popgen.stored_blocks(cells)
    genotyped = popgen.called_samples(cells)
    return _for_samples(genotyped.join(_shares_by_sample(shares), "sample_id"), stored(group_frequencies(cells, shares)),
                        ["sample_id"], "pe_combined", combined)


def group_likelihood_ratios(cells: DataFrame, shares: DataFrame, pedigree: DataFrame,
                            error_rate: float = popgen.ERROR_RATE) -> DataFrame:
    """``popgen.likelihood_ratios`` at the child's own frequencies; for children with shares."""
    def ratio(p: np.ndarray, row: dict) -> tuple[int, float]:
        child, parent = popgen.padded(row["cs"], len(p)), popgen.padded(row["gs"], len(p))
        at = np.flatnonzero((child < 3) & (parent < 3) & ~np.isnan(p))
        p, child, dose = p[at], child[at], parent[at] / 2  # dose: the chance that the parent hands on A
        base = np.choose(child, popgen.prior(p))
        chance = np.choose(child, [(1 - dose) * (1 - p), dose * (1 - p) + (1 - dose) * p, dose * p])
        return len(at), float(np.log(((1 - error_rate) * chance + error_rate * base) / base).sum())

    cells = popgen.stored_blocks(cells)
    if popgen.is_rows(cells):
        groups, mixes = stored(group_frequencies(cells, shares)), _shares_by_sample(shares).withColumnRenamed("sample_id", "child")
        related = popgen.parent_pairs(pedigree).join(mixes.select("child"), "child", "left_semi")
        return samplerows.union([stored(_for_samples(pairs.join(mixes, "child"), groups, ["child", "parent", "role"], "lod", ratio), "group-lod")
                                 for pairs in popgen.related_codes(cells, related)])
    calls = stored(popgen.genotypes(cells), "genotypes")
    pairs = (popgen.parent_pairs(pedigree)
             .join(calls.withColumnsRenamed({"sample_id": "child", "codes": "cs"}), "child")
             .join(calls.withColumnsRenamed({"sample_id": "parent", "codes": "gs"}), ["map_name", "parent"])
             .join(_shares_by_sample(shares).withColumnRenamed("sample_id", "child"), "child"))
    return _for_samples(pairs, stored(group_frequencies(cells, shares)), ["child", "parent", "role"], "lod", ratio)
