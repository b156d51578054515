"""Population-genetics measures over encoded genotypes (documented extensions).

All inputs are the long winner table of ``encode.last_calls``:
(nume_cari, sample_id, map_name, pos, code) with code in {0, 1, 2, 5};
0 = BB, 1 = AB, 2 = AA, 5 = no call.  p is the frequency of allele A.
A position belongs to its map, so everything is keyed by (map_name, pos).  A
sample of several uploads counts once: at each position its call from the
latest upload (largest id) that called it holds.

Calls are packed once (``call_blocks``), before they are shuffled; every measure that takes cells takes these blocks too.
So do those of dense maps with a row for each sample (``sample_rows``): a call takes two bits there, and
what is shuffled of a pass over them is bounded.

Pair comparisons never emit per-position pair rows for whole genomes when
a bitset does: each sample's calls are packed into 64-position blocks
(three longs per block: is-BB, is-AB, is-AA), the pedigree pairs are joined to
the child's blocks and then to the parent's block with the same index, and
``bit_count`` of combined masks gives the counts.  A popular parent is a hot
join key on one side only; AQE's skew-join split handles it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators import samplerows
from genospark.operators.samplerows import BLOCK, bounded_batches, is_rows
from genospark.session import scratch_path, stored

#: Sums by block that a task holds, and sends on when it has more.
HELD = 4096
ERROR_RATE = 0.01
MAX_CONFLICT_RATE = 0.01


def bor(*cols):
    out = cols[0]
    for c in cols[1:]:
        out = out.bitwiseOR(c)
    return out


def band(*cols):
    out = cols[0]
    for c in cols[1:]:
        out = out.bitwiseAND(c)
    return out


def called(code):
    return code.isin(0, 1, 2)


def current_calls(cells: DataFrame) -> DataFrame:
    """(map_name, sample_id, pos, code): one call per sample and position, the latest upload's."""
    return (cells.where(called(F.col("code"))).groupBy("map_name", "sample_id", "pos")
            .agg(F.max_by("code", "nume_cari").alias("code")))


def call_blocks(cells: DataFrame) -> DataFrame:
    """(map_name, sample_id, block, b0, b1, b2, seen): ``current_calls`` as bits, one row per sample and 64-position block
    with a row in ``cells``; ``seen`` has the positions of these rows, called or not.  Call blocks stay as they are, and sample
    rows are cut into theirs.

    A sample's calls lie together in a table of winners, so most are added up before the shuffle.
    """
    if is_rows(cells):
        return samplerows.blocks(cells)
    if "seen" in cells.columns:
        return cells
    c, zero = F.col("code"), F.lit(0).cast("long")
    bit = F.expr(f"shiftleft(CAST(1 AS BIGINT), CAST(pos % {BLOCK} AS INT))")
    masks = [F.coalesce(F.bit_or(F.when((c == k) & F.col("nume_cari").isNotNull(), bit)), zero).alias(f"b{k}") for k in range(3)]
    uploads = cells.groupBy("map_name", "sample_id", (F.col("pos") / BLOCK).cast("int").alias("block"), "nume_cari").agg(
        *masks, F.coalesce(F.bit_or(bit), zero).alias("seen"))
    return _latest(uploads)


def _latest(uploads: DataFrame) -> DataFrame:
    """Call blocks of blocks by upload."""
    # a row holds a sample's uploads; an earlier one counts where no later one called
    latest = ("aggregate(reverse(array_sort(uploads)), named_struct('b0', 0L, 'b1', 0L, 'b2', 0L), (s, u) -> named_struct("
              + ", ".join(f"'b{k}', s.b{k} | (u.b{k} & ~(s.b0 | s.b1 | s.b2))" for k in range(3)) + "))")
    each = uploads.groupBy("map_name", "sample_id", "block").agg(
        F.collect_list(F.struct("nume_cari", "b0", "b1", "b2")).alias("uploads"), F.bit_or("seen").alias("seen"))
    return each.withColumn("c", F.expr(latest)).select("map_name", "sample_id", "block", "c.b0", "c.b1", "c.b2", "seen")


def sample_rows(cells: DataFrame) -> DataFrame:
    """The calls of ``call_blocks`` as a stored table of one row a sample (``samplerows``), for dense maps; measures take it for cells."""
    def latest(blocks: DataFrame) -> DataFrame:
        same = blocks.groupBy("map_name", "sample_id", "block", "nume_cari").agg(
            *[F.bit_or(b).alias(b) for b in ("b0", "b1", "b2", "seen")])
        return _latest(same)
    return samplerows.sample_rows(cells, latest)


def stored_blocks(cells: DataFrame) -> DataFrame:
    """``call_blocks`` as a stored table; call blocks and sample rows stay as they are."""
    return cells if "seen" in cells.columns else stored(call_blocks(cells), "call-blocks")


def seen_positions(blocks: DataFrame) -> DataFrame:
    """(map_name, pos): the distinct positions of call blocks."""
    seen = call_blocks(blocks).groupBy("map_name", "block").agg(F.bit_or("seen").alias("seen"))
    return (seen.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))))
            .where("shiftright(seen, bit) & 1 = 1").select("map_name", (F.col("block") * BLOCK + F.col("bit")).alias("pos")))


def bits_of(column: pa.Array) -> np.ndarray:
    """The bits of longs: a row of 64 for each."""
    longs = np.ascontiguousarray(column.to_numpy(zero_copy_only=False).astype("<i8"))
    return np.unpackbits(longs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def summed(values: np.ndarray, group: np.ndarray, n: int, kind: type) -> np.ndarray:
    """Sums of the rows of ``values`` by ``group``, each of 0 to ``n`` - 1 at least once."""
    order = np.argsort(group, kind="stable")
    return np.add.reduceat(values[order], np.searchsorted(group[order], np.arange(n)), axis=0, dtype=kind)


def block_sums(rows: DataFrame, keys: list[str], kind: type, width: int, part: Callable, finish: Callable,
               fields: str) -> DataFrame:
    """Sums by ``keys``, the map and block among them, of what ``part`` (batch, group of each row, groups) gives as a row of
    64 x ``width`` numbers of ``kind`` for each group.  ``finish`` makes columns of (positions in the block, their sums);
    ``fields`` are the keys, pos and these columns.

    A task adds its rows up first and holds ``HELD`` sums at most; Spark brings the sums of a block together.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in fields.split(", ")])
    key_schema = pa.schema([schema.field(k) if k != "block" else pa.field("block", pa.int32()) for k in keys])
    block = keys.index("block")

    def table(sums: dict[tuple, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(c, key_schema.field(k).type) for k, c in enumerate(zip(*sums, strict=True))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                          names=[*keys, "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            index: dict[tuple, int] = {}
            group = np.fromiter((index.setdefault(k, len(index)) for k in zip(*(batch.column(k).to_pylist() for k in keys), strict=True)),
                                np.int64, batch.num_rows)
            found = part(batch, group, len(index)).reshape(len(index), BLOCK * width)
            for key, k in index.items():
                sums[key] = sums[key] + found[k] if key in sums else found[k].astype(kind)
            if len(sums) > HELD:
                yield table(sums)
                sums = {}
        if sums:
            yield table(sums)

    def ended(key: tuple, total: np.ndarray) -> pa.RecordBatch:
        at, columns = finish(total.reshape(BLOCK, width))
        held = [pa.array([v] * len(at), key_schema.field(k).type) for k, v in enumerate(key) if k != block]
        return pa.RecordBatch.from_arrays([*held, pa.array(key[block] * BLOCK + at, pa.int32()),
                                           *(pa.array(c) for c in columns)], schema=schema)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for *new, sums in zip(*(c.to_pylist() for c in batch.columns[:len(keys) + 1]), strict=True):
                if key is not None and tuple(new) != key:
                    yield ended(key, held)
                    key = None
                held = np.frombuffer(sums, kind) if key is None else held + np.frombuffer(sums, kind)
                key = tuple(new)
        if key is not None:
            yield ended(key, held)

    assert names == [k for k in keys if k != "block"] + names[len(keys) - 1:]
    key_fields = ", ".join(f"{k} {'int' if k == 'block' else 'string'}" for k in keys)
    # added in the order of tasks, so that sums of doubles repeat
    parts = rows.mapInArrow(add, key_fields + ", sums binary").withColumn("task", F.spark_partition_id())
    return (parts.repartition(*keys).sortWithinPartitions(*keys, "task").drop("task")
            .mapInArrow(total, fields))


def genotype_counts(cells: DataFrame) -> DataFrame:
    """(map_name, pos, n0, n1, n2) of the called positions of ``cells`` or call blocks."""
    def part(batch: pa.RecordBatch, group: np.ndarray, n: int) -> np.ndarray:
        return summed(np.stack([bits_of(batch.column(b)) for b in ("b0", "b1", "b2")], axis=2), group, n, np.int64)

    def finish(sums: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        at = np.flatnonzero(sums.any(axis=1))
        return at, list(sums[at].T)
    return block_sums(bitsets(cells).drop("sample_id"), ["map_name", "block"], np.int64, 3, part, finish,
                      "map_name string, pos int, n0 long, n1 long, n2 long")


def allele_frequencies(cells: DataFrame, positions: DataFrame,
                       min_maf: float = 0.05, min_call_rate: float = 0.90) -> DataFrame:
    """Per map position: genotype counts, frequency of A, MAF, call rate and panel suitability."""
    samples = cells.groupBy("map_name").agg(F.countDistinct("sample_id").alias("n_samples"))
    counts = genotype_counts(cells)
    out = (positions.join(counts, ["map_name", "pos"], "left").join(F.broadcast(samples), "map_name")
           .fillna(0, ["n0", "n1", "n2"]))
    n = F.col("n0") + F.col("n1") + F.col("n2")
    p = (2 * F.col("n2") + F.col("n1")) / (2 * n)
    out = out.select("map_name", "pos", F.col("snp_key").alias("snp_name"), "n0", "n1", "n2",
                     n.alias("n_called"), "n_samples", F.when(n > 0, p).alias("p"))
    return out.select(
        "map_name", "pos", "snp_name", "n0", "n1", "n2", "n_called", "n_samples",
        F.round("p", 6).alias("p_a"), F.round(F.least(F.col("p"), 1 - F.col("p")), 6).alias("maf"),
        F.bround(F.col("n_called") / F.col("n_samples"), 4).alias("call_rate"),
        (F.coalesce(F.least(F.col("p"), 1 - F.col("p")) >= min_maf, F.lit(False))
         & (F.col("n_called") / F.col("n_samples") >= min_call_rate)).alias("informative"))


def hardy_weinberg(freqs: DataFrame) -> DataFrame:
    """Per SNP with calls: the exact test of Hardy-Weinberg proportions and the deficit of heterozygotes.

    ``p_value`` is the chance, given the two allele counts, of a number of heterozygotes that is at most as likely
    as the one found; 1 for a SNP with one allele.  The chances of all possible numbers follow from each other two
    heterozygotes at a time, so they are summed relative to the number found, upwards and downwards from it;
    where that sum is beyond a double, the p-value is 0.  ``f`` is 1 - observed / expected heterozygotes, null
    with one allele.  Column expressions on the rows of ``allele_frequencies``: no shuffle, steps as many as calls.
    """
    rare, common = "least(n0, n2)", "greatest(n0, n2)"

    def summed(steps: str, ratio: str) -> str:
        """Sum of the chances over the steps, and of those not above 1; step ``i`` starts with ``h`` heterozygotes."""
        return (f"aggregate(CASE WHEN {steps} > 0 THEN sequence(1L, {steps}) ELSE array() END, "
                f"named_struct('p', 1D, 'all', 0D, 'tail', 0D), "
                f"(s, i) -> transform(array(s.p * {ratio}), p -> named_struct("
                f"'p', p, 'all', s.all + p, 'tail', s.tail + if(p <= 1.0000001D, p, 0D)))[0])")

    up = summed(rare, f"(4D * ({rare} - i + 1) * ({common} - i + 1) / ((n1 + 2D * i) * (n1 + 2D * i - 1)))")
    down = summed("(n1 div 2)", f"((n1 - 2D * i + 2) * (n1 - 2D * i + 1) / (4D * ({rare} + i) * ({common} + i)))")
    sums = freqs.where("n_called > 0").withColumns({"up": F.expr(up), "down": F.expr(down)})
    p = (2 * F.col("n2") + F.col("n1")) / (2 * F.col("n_called"))
    expected = 2 * p * (1 - p) * F.col("n_called")
    return sums.select(
        "map_name", "pos", "snp_name", "n0", "n1", "n2",
        F.expr("least(1D, (1 + up.tail + down.tail) / (1 + up.all + down.all))").alias("p_value"),
        F.when(expected > 0, 1 - F.col("n1") / expected).alias("f"))


def bitsets(cells: DataFrame) -> DataFrame:
    """(map_name, sample_id, block, b0, b1, b2): one row per sample and 64-position block with any call."""
    return call_blocks(cells).where("b0 | b1 | b2 <> 0").drop("seen")


def called_samples(cells: DataFrame) -> DataFrame:
    """(map_name, sample_id) of the samples with any call."""
    rows = cells.where("n_called > 0") if is_rows(cells) else bitsets(cells)
    return rows.select("map_name", "sample_id").distinct()


def parent_pairs(pedigree: DataFrame) -> DataFrame:
    """(child, parent, role) for sire and dam."""
    return (pedigree.select("child", F.col("sire").alias("parent"), F.lit("sire").alias("role"))
            .unionByName(pedigree.select("child", F.col("dam").alias("parent"), F.lit("dam").alias("role")))
            .where(F.col("parent").isNotNull()))


def _side(bits: DataFrame, who: str) -> DataFrame:
    return bits.select("map_name", F.col("sample_id").alias(who), "block",
                       *[F.col(b).alias(f"{who}_{b}") for b in ("b0", "b1", "b2")])


def opposing_homozygotes(cells: DataFrame, pedigree: DataFrame) -> DataFrame:
    """Per (map_name, child, parent, role) with both genotyped on the map: jointly called SNPs and
    opposing homozygotes."""
    cells = stored_blocks(cells)
    genotyped = cells.select("map_name", "sample_id").distinct()
    pairs = (parent_pairs(pedigree)
             .join(genotyped.withColumnRenamed("sample_id", "child"), "child")
             .join(genotyped.withColumnRenamed("sample_id", "parent"), ["map_name", "parent"], "left_semi"))
    if is_rows(cells):
        pairs = stored(pairs, "pairs")
        return pairs.join(_opposing_by_child(cells, pairs), ["map_name", "child", "parent", "role"], "left").fillna(
            0, ["n_compared", "n_opposing"])
    bits = bitsets(cells)
    j = (pairs.join(_side(bits, "child"), ["map_name", "child"])
         .join(_side(bits, "parent"), ["map_name", "parent", "block"]))
    b = {k: F.col(k) for k in j.columns}
    cc = bor(b["child_b0"], b["child_b1"], b["child_b2"])
    pc = bor(b["parent_b0"], b["parent_b1"], b["parent_b2"])
    opp = bor(band(b["child_b0"], b["parent_b2"]), band(b["child_b2"], b["parent_b0"]))
    sums = j.groupBy("map_name", "child", "parent", "role").agg(
        F.sum(F.bit_count(band(cc, pc))).cast("long").alias("n_compared"),
        F.sum(F.bit_count(opp)).cast("long").alias("n_opposing"))
    return (pairs.join(sums, ["map_name", "child", "parent", "role"], "left")
            .fillna(0, ["n_compared", "n_opposing"]))


_PAIRS = "map_name string, child string, parent string, role string, n_compared long, n_opposing long"


def own_and_others(pairs: DataFrame, other: str, *more: str) -> DataFrame:
    """What ``samplerows.by_key`` wants of a child: its own row (``kind`` 0) and those of the ``other`` column with ``more`` columns."""
    own = pairs.select("child", F.col("child").alias("sample_id"), F.lit(0).alias("kind"), *(
        F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in more), *({"map_name"} & set(pairs.columns))).distinct()
    return own.unionByName(pairs.select("child", F.col(other).alias("sample_id"), F.lit(1).alias("kind"), *more,
                                        *({"map_name"} & set(pairs.columns))))


def _opposing_by_child(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The counts of ``opposing_homozygotes`` of the ``pairs`` that both have calls, from sample rows."""
    counted = pairs.groupBy("map_name", "child", "parent", "role").agg(F.count(F.lit(1)).alias("times"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            found = []
            for name, child, sample, kind, role, times, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    key, own = (name, child), samplerows.planes(*row)
                elif (name, child) == key:
                    (c0, c1, c2), (p0, p1, p2) = samplerows.shared(own, samplerows.planes(*row))
                    found.append((name, child, sample, role, times * int(np.bitwise_count((c0 | c1 | c2) & (p0 | p1 | p2)).sum(dtype=np.int64)),
                                  times * int(np.bitwise_count((c0 & p2) | (c2 & p0)).sum(dtype=np.int64))))
            yield samplerows.batch_of(found, _PAIRS)
    wanted = own_and_others(counted, "parent", "role", "times").select("map_name", "child", "sample_id", "kind", "role", "times")
    return samplerows.union([stored(part, "opposing") for part in samplerows.by_key(rows, wanted, ["child"], run, _PAIRS)])


def related_codes(rows: DataFrame, pairs: DataFrame) -> list[DataFrame]:
    """By pass over sample rows: (map_name, child, parent, role, cs, gs) of the (child, parent, role) that both have calls."""
    fields = "map_name string, child string, parent string, role string, cs binary, gs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            for name, child, sample, kind, role, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = row_codes(*samplerows.planes(*row))
                if kind == 0:
                    key, own = (name, child), codes
                elif (name, child) == key:
                    yield samplerows.batch_of([(name, child, sample, role, own, codes)], fields)
    wanted = own_and_others(pairs, "parent", "role").select("child", "sample_id", "kind", "role")
    return samplerows.by_key(rows, wanted, ["child"], run, fields)


def _verdict(opp, cmp, max_rate):
    return (F.when(cmp == 0, "untested").when(opp / cmp <= max_rate, "compatible").otherwise("excluded"))


def parent_verdicts(cells: DataFrame, pedigree: DataFrame, max_rate: float = MAX_CONFLICT_RATE) -> DataFrame:
    """Per map and child with sire and dam genotyped on it: each parent's verdict and Mendelian
    trio conflicts."""
    cells = stored_blocks(cells)
    bits = bitsets(cells)
    genotyped = cells.select("map_name", "sample_id").distinct()
    trios = pedigree.select("child", "sire", "dam").join(genotyped.withColumnRenamed("sample_id", "child"), "child")
    for who in ("sire", "dam"):
        trios = trios.join(genotyped.withColumnRenamed("sample_id", who), ["map_name", who], "left_semi")
    j = (trios.join(_side(bits, "child"), ["map_name", "child"])
         .join(_side(bits, "sire"), ["map_name", "sire", "block"], "left")
         .join(_side(bits, "dam"), ["map_name", "dam", "block"], "left")
         .fillna(0))
    b = {k: F.col(k) for k in j.columns}
    cc = bor(b["child_b0"], b["child_b1"], b["child_b2"])
    sc = bor(b["sire_b0"], b["sire_b1"], b["sire_b2"])
    dc = bor(b["dam_b0"], b["dam_b1"], b["dam_b2"])
    s_opp = bor(band(b["child_b0"], b["sire_b2"]), band(b["child_b2"], b["sire_b0"]))
    d_opp = bor(band(b["child_b0"], b["dam_b2"]), band(b["child_b2"], b["dam_b0"]))
    mendel = bor(band(b["child_b2"], bor(b["sire_b0"], b["dam_b0"])),
                 band(b["child_b0"], bor(b["sire_b2"], b["dam_b2"])),
                 band(b["child_b1"], bor(band(b["sire_b0"], b["dam_b0"]), band(b["sire_b2"], b["dam_b2"]))))
    all3 = band(cc, sc, dc)
    sums = j.groupBy("map_name", "child", "sire", "dam").agg(
        F.sum(F.bit_count(band(cc, sc))).cast("long").alias("sire_compared"),
        F.sum(F.bit_count(s_opp)).cast("long").alias("sire_opposing"),
        F.sum(F.bit_count(band(cc, dc))).cast("long").alias("dam_compared"),
        F.sum(F.bit_count(d_opp)).cast("long").alias("dam_opposing"),
        F.sum(F.bit_count(all3)).cast("long").alias("trio_compared"),
        F.sum(F.bit_count(band(mendel, all3))).cast("long").alias("trio_conflicts"))
    out = trios.join(sums, ["map_name", "child", "sire", "dam"], "left").fillna(0)
    return out.select(
        "map_name", "child", "sire", "dam", "sire_compared", "sire_opposing",
        _verdict(F.col("sire_opposing"), F.col("sire_compared"), max_rate).alias("sire_verdict"),
        "dam_compared", "dam_opposing",
        _verdict(F.col("dam_opposing"), F.col("dam_compared"), max_rate).alias("dam_verdict"),
        "trio_compared", "trio_conflicts")


def exclusion_probability(freqs: DataFrame) -> DataFrame:
    """Per map: combined single-parent exclusion probability 1 - prod(1 - 2 p^2 q^2) over polymorphic SNPs."""
    p = F.col("p_raw")
    f = freqs.where(F.col("n_called") > 0).withColumn(
        "p_raw", (2 * F.col("n2") + F.col("n1")) / (2 * F.col("n_called")))
    f = f.where((p > 0) & (p < 1)).withColumn("pe", 2 * p * p * (1 - p) * (1 - p))
    return f.groupBy("map_name").agg(
        F.count(F.lit(1)).alias("n_snps"),
        F.round(1 - F.exp(F.sum(F.log(1 - F.col("pe")))), 6).alias("pe_combined"),
        F.round(F.avg("pe"), 6).alias("pe_mean"))


def prior(p: np.ndarray) -> np.ndarray:
    """Chance of each genotype at allele frequency ``p``, as rows."""
    q = 1 - p
    return np.stack([q * q, 2 * p * q, p * p])


#: First byte of a sample's packed calls that name their positions (codes are 5 at most).
BY_POSITION = b"\x06"

def packed(at: np.ndarray, code: np.ndarray) -> bytes:
    """A sample's calls: a byte for each position of the map up to its last call, 5 for none; of a sample with few calls
    ``BY_POSITION``, the called positions in order (four bytes each) and their codes."""
    if at.max() + 1 > 5 * len(at):
        order = np.argsort(at)
        return BY_POSITION + at[order].astype("<u4").tobytes() + code[order].astype(np.uint8).tobytes()
    codes = np.full(at.max() + 1, 5, np.uint8)
    codes[at] = code
    return codes.tobytes()


def calls_of(codes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The called positions of ``packed`` calls, in order, and their codes."""
    if codes[:1] == BY_POSITION:
        n = len(codes) // 5
        return np.frombuffer(codes, "<u4", n, 1).astype(np.int64), np.frombuffer(codes, np.uint8, n, 1 + 4 * n)
    dense = np.frombuffer(codes, np.uint8)
    at = np.flatnonzero(dense < 3)
    return at, dense[at]


def genotypes(cells: DataFrame) -> DataFrame:
    """(map_name, sample_id, codes): the calls of a sample, ``packed``."""
    bounded_batches(cells.sparkSession)
    if is_rows(cells):
        return _codes_of_rows(cells)
    # a group is one sample's blocks on a map
    calls = bitsets(cells).groupBy("map_name", "sample_id").agg(F.collect_list(F.struct("block", "b0", "b1", "b2")).alias("blocks"))

    def codes_of(blocks: pa.StructArray) -> bytes:
        b0, b1, b2 = (bits_of(blocks.field(b)) for b in ("b0", "b1", "b2"))
        row, bit = np.nonzero(b0 | b1 | b2)
        return packed(blocks.field("block").to_numpy().astype(np.int64)[row] * BLOCK + bit, (b1 + 2 * b2)[row, bit])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [codes_of(blocks.values) for blocks in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["map_name", "sample_id", "codes"])
    return calls.mapInArrow(run, "map_name string, sample_id string, codes binary")


def row_codes(block: np.ndarray, b0: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> bytes:
    """``packed`` calls of a sample row with any."""
    b0, b1, b2 = (np.unpackbits(np.ascontiguousarray(b).view(np.uint8), bitorder="little") for b in (b0, b1, b2))
    bit = np.flatnonzero(b0 | b1 | b2)
    return packed(block[bit // BLOCK] * BLOCK + bit % BLOCK, (b1 + 2 * b2)[bit])


def _codes_of_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row_codes(*samplerows.planes(*row)) for row in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["map_name", "sample_id", "codes"])
    return rows.where("n_called > 0").select("map_name", "sample_id", *samplerows.PLANES).mapInArrow(
        run, "map_name string, sample_id string, codes binary")


def frequencies_by_map(freqs: DataFrame) -> dict[str, np.ndarray]:
    """Frequency of A by position of each map, NaN where no call is: eight bytes for each SNP of a registered map."""
    rows = freqs.where("n_called > 0").select(
        "map_name", F.col("pos").cast("int"), ((2 * F.col("n2") + F.col("n1")) / (2 * F.col("n_called"))).alias("p")).toArrow()
    out: dict[str, np.ndarray] = {}
    names, pos, p = rows["map_name"].to_numpy(), rows["pos"].to_numpy(), rows["p"].to_numpy()
    for name in np.unique(names.astype(str)):
        mine = names == name
        out[name] = np.full(pos[mine].max() + 1, np.nan)
        out[name][pos[mine]] = p[mine]
    return out


def padded(codes: bytes, size: int) -> np.ndarray:
    """``packed`` calls as a code for each of the first ``size`` positions."""
    out = np.full(size, 5, np.uint8)
    if codes[:1] == BY_POSITION:
        at, code = calls_of(codes)
        n = np.searchsorted(at, size)
        out[at[:n]] = code[:n]
        return out
    got = np.frombuffer(codes, np.uint8)[:size]
    out[:len(got)] = got
    return out


def _pair_terms(frequencies, error_rate: float):
    """Sum over SNPs of ln(((1 - e) T(child | parent) + e P(child)) / P(child)) for rows of two samples' codes."""
    def terms(map_name: str, at: np.ndarray, child: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The terms of the positions that have two alleles; nothing is kept for the rest of the map."""
        p = frequencies.value[map_name]
        inside = at < len(p)
        p, child, parent = p[at[inside]], child[inside], parent[inside]
        use = (p > 0) & (p < 1)  # NaN where no call is
        p, child, parent = p[use], child[use], parent[use]
        q, zero = 1 - p, np.zeros(len(p))
        chance = np.choose(3 * child + parent, [q, q / 2, zero, p, np.full(len(p), 0.5), q, zero, p / 2, p])
        base = np.choose(child, prior(p))
        return np.log(((1 - error_rate) * chance + error_rate * base) / base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rest = batch.column(0).to_pylist(), batch.columns[:4]
            sizes, sums = [], []
            for name, child, parent in zip(names, batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                (c_at, c), (g_at, g) = calls_of(child), calls_of(parent)
                at, in_child, in_parent = np.intersect1d(c_at, g_at, assume_unique=True, return_indices=True)
                values = terms(name, at, c[in_child], g[in_parent]) if len(at) else np.zeros(0)
                sizes.append(len(values))
                sums.append(round(float(values.sum()), 4))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                                             names=["map_name", "child", "parent", "role", "n_snps", "lod"])
    return run


def likelihood_ratios(cells: DataFrame, freqs: DataFrame, pedigree: DataFrame,
                      error_rate: float = ERROR_RATE) -> DataFrame:
    """Per (map_name, child, parent, role): LOD = sum ln(((1-e) T(c|g) + e P(c)) / P(c)) over jointly
    called polymorphic SNPs.

    Each sample's calls are packed once, so a row grows with the calls and not with the map; a pair's row has both,
    and its terms are computed at the SNPs that both have, from frequencies that are bounded by the map.
    """
    calls = stored(genotypes(cells), "genotypes")
    j = (parent_pairs(pedigree)
         .join(calls.withColumnsRenamed({"sample_id": "child", "codes": "cs"}), "child")
         .join(calls.withColumnsRenamed({"sample_id": "parent", "codes": "gs"}), ["map_name", "parent"]))
    frequencies = cells.sparkSession.sparkContext.broadcast(frequencies_by_map(freqs))
    return (j.select("map_name", "child", "parent", "role", "cs", "gs")
            .mapInArrow(_pair_terms(frequencies, error_rate),
                        "map_name string, child string, parent string, role string, n_snps long, lod double")
            .where("n_snps > 0"))


def ancestors(pedigree: DataFrame) -> DataFrame:
    """(sample, ancestor, generation): transitive closure of sire/dam, shortest generation.

    Breadth-first: each round joins the newest frontier with the parent
    edges and drops pairs already found; it ends when nothing is new, which also
    ends on a cycle.  Each round is one partition of a table in the shared
    checkpoint folder, so found pairs are written once and a lost executor
    only recomputes the current round.
    """
    spark = pedigree.sparkSession
    edges = stored(parent_pairs(pedigree).select("child", "parent").distinct())
    base = scratch_path(spark, "ancestors")
    step = edges.select(F.col("child").alias("sample"), F.col("parent").alias("ancestor"))
    schema, generation = "sample string, ancestor string, generation int", 1
    while True:
        step.write.parquet(f"{base}/generation={generation}")
        frontier = spark.read.parquet(f"{base}/generation={generation}")
        found = spark.read.schema(schema).parquet(base)
        if frontier.isEmpty():
            return found
        step = (frontier.join(edges.select(F.col("child").alias("ancestor"), "parent"), "ancestor")
                .select("sample", F.col("parent").alias("ancestor")).distinct()
                .join(found.select("sample", "ancestor"), ["sample", "ancestor"], "left_anti"))
        generation += 1


def sibling_counts(pedigree: DataFrame) -> DataFrame:
    """Per child: full sibs and paternal / maternal half sibs, from group sizes (no pair list).

    Every child has a row.  Full sibs share both parents, both known.  All others that share a known
    sire (dam) count as paternal (maternal) half sibs; ``n_paternal_unresolved`` (``n_maternal_unresolved``) of
    them could be full sibs, since the other parent of either is unknown.
    """
    ped = pedigree.select("child", "sire", "dam")
    by_both = ped.where("sire IS NOT NULL AND dam IS NOT NULL").groupBy("sire", "dam").agg(F.count(F.lit(1)).alias("n_both"))
    out = ped.join(by_both, ["sire", "dam"], "left")
    full = F.coalesce(F.col("n_both") - 1, F.lit(0))
    counts = [full.alias("n_full_sibs")]
    for side, parent, other in (("paternal", "sire", "dam"), ("maternal", "dam", "sire")):
        sizes = ped.where(F.col(parent).isNotNull()).groupBy(parent).agg(
            F.count(F.lit(1)).alias(f"n_{parent}"), F.count(F.when(F.col(other).isNull(), 1)).alias(f"open_{parent}"))
        out = out.join(sizes, parent, "left")
        half = F.coalesce(F.col(f"n_{parent}") - 1 - full, F.lit(0))
        unresolved = F.when(F.col(other).isNull(), half).otherwise(F.coalesce(f"open_{parent}", F.lit(0)))
        counts += [half.alias(f"n_{side}_half_sibs"), unresolved.alias(f"n_{side}_unresolved")]
    return out.select("child", "sire", "dam", *counts)


def fst(cells: DataFrame, positions: DataFrame, group_col: str = "nume_cari") -> DataFrame:
    """Per SNP: Fst = (Ht - Hs) / Ht over groups (uploads), expected heterozygosities 2p(1-p)."""
    c = F.col("code")
    per = (cells.where(called(c)).groupBy("map_name", "pos", group_col).agg(
        ((2 * F.count(F.when(c == 2, 1)) + F.count(F.when(c == 1, 1))) / (2 * F.count(F.lit(1)))).alias("p")))
    agg = per.groupBy("map_name", "pos").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg(2 * F.col("p") * (1 - F.col("p"))).alias("hs"),
        F.avg("p").alias("pbar"))
    ht = 2 * F.col("pbar") * (1 - F.col("pbar"))
    out = agg.select("map_name", "pos", "n_groups", "hs", ht.alias("ht"))
    return (out.join(positions.select("map_name", "pos", F.col("snp_key").alias("snp_name")), ["map_name", "pos"])
            .select("map_name", "pos", "snp_name", "n_groups", F.round("hs", 6).alias("hs"),
                    F.round("ht", 6).alias("ht"),
                    F.round(F.when(F.col("ht") > 0, (F.col("ht") - F.col("hs")) / F.col("ht")), 6).alias("fst")))
