"""Genotype encoding: long allele calls -> one fixed-order digit string per sample.

Inputs
  calls      (nume_cari, line_no, sample_id, snp_name, a1, a2, map_name)
             one row per report data line; ``map_name`` is the map the upload
             is encoded against.
  snp_maps   (map_name, id, snp_name); file order of a map is ``id`` order.

Plan (one shuffle, by sample; groups are bounded by the chip):
  1. positions per map: distinct upper-cased names, first id kept, dense from 0.
  2. calls LEFT JOIN positions (stored, so its size is known), decode the pair.
  3. last decodable call per (upload, sample, position): aggregated behind the
     one exchange, on its partitioning; copies of a call travel with their sample.
  4. per (upload, sample): sorted (pos, code) array, gaps filled with '5',
     ``n_called`` for the call rate.  A group holds at most one row per map
     position, so its size is bounded by the map, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genospark.functions.columns import allele_ok, decode_pair
from genospark.schemas import MISSING_DIGIT
from genospark.session import stored

UPLOAD_SAMPLE = ["nume_cari", "sample_id", "map_name"]
#: Bytes of a call in an array, where a digit of a string has one.
CALL_BYTES = 32
#: Names of maps from which on calls are no longer joined with a broadcast, about.
MANY_NAMES = 1 << 20


def map_positions(snp_maps: DataFrame) -> DataFrame:
    """(map_name, snp_key, pos, n_snp): dense position per distinct upper-cased name, map size.

    One window per map (a map is bounded by its chip, < 1M names), computed
    once and stored: the size check, the broadcast and the map sizes all read
    the stored rows.
    """
    first = (snp_maps
             .select("map_name", F.upper("snp_name").alias("snp_key"), "id")
             .groupBy("map_name", "snp_key").agg(F.min("id").alias("id")))
    w = Window.partitionBy("map_name").orderBy("id")
    return stored(first.select(
        "map_name", "snp_key", (F.row_number().over(w) - 1).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy("map_name")).cast("int").alias("n_snp")), "positions")


def map_sizes(positions: DataFrame) -> DataFrame:
    return positions.select("map_name", "n_snp").distinct()


def decoded_calls(calls: DataFrame) -> DataFrame:
    """Calls with ``snp_key`` (upper name) and ``code`` (0,1,2,5 or null)."""
    return calls.withColumn("snp_key", F.upper("snp_name")).withColumn(
        "code", decode_pair(F.col("a1"), F.col("a2")))


def positioned_calls(calls: DataFrame, positions: DataFrame) -> DataFrame:
    """Decoded calls with their map position (null when the name is not in the map)."""
    pos = positions.select("map_name", "snp_key", "pos")  # stored: broadcast from its size, else AQE
    return decoded_calls(calls).join(pos, ["map_name", "snp_key"], "left")


def last_calls(calls: DataFrame, positions: DataFrame, keep_unplaced: bool = False) -> DataFrame:
    """Winning call per (upload, sample, position): the last decodable line.

    With ``keep_unplaced`` every sample also keeps a row without a position,
    so that samples without any usable call are not lost; of other calls outside the map nothing is shuffled.
    """
    columns = [*UPLOAD_SAMPLE, "pos", "code", "line_no"]
    pc = positioned_calls(calls, positions).where(F.col("pos").isNotNull() & F.col("code").isNotNull()).select(*columns)
    if keep_unplaced:
        if positions.count() > MANY_NAMES:  # the join shuffles calls too: its files are gone before the next shuffle
            pc = stored(pc, "placed-calls", "zstd")
        nowhere = [F.lit(None).cast(pc.schema[c].dataType).alias(c) for c in columns[len(UPLOAD_SAMPLE):]]
        pc = pc.unionByName(calls.select(*UPLOAD_SAMPLE).distinct().select(*UPLOAD_SAMPLE, *nowhere))
    usable = F.col("code").isNotNull()
    # one exchange of calls: both aggregates (per position, per sample) run on this partitioning
    pc = pc.repartition(*UPLOAD_SAMPLE)
    return (pc.groupBy(*UPLOAD_SAMPLE, "pos")
            .agg(F.max_by("code", F.when(usable, F.col("line_no"))).alias("code"),
                 F.max(F.when(usable, F.col("line_no"))).alias("line_no")))


def sample_calls(calls: DataFrame, snp_maps: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """(nume_cari, sample_id, map_name, n_snp, n_called, genotype, calls) for every sample of every upload.

    What is shuffled further has the digit string only of a sample whose calls are not far fewer than its map;
    else ``calls``, its sorted (pos, code), from which ``spelled`` makes the string.  The other one is null.
    """
    if positions is None:
        positions = map_positions(snp_maps)
    sizes = F.broadcast(map_sizes(positions))  # one row per map: bounded by the catalogue
    winners = last_calls(calls, positions, keep_unplaced=True)
    placed = F.col("pos").isNotNull() & F.col("code").isNotNull()
    per_sample = (winners.groupBy(*UPLOAD_SAMPLE).agg(
        F.array_sort(F.collect_list(F.when(placed, F.struct("pos", "code")))).alias("calls"),
        F.sum(F.when(placed & (F.col("code") != 5), 1).otherwise(0)).cast("int").alias("n_called")))
    dense = F.col("n_snp") <= CALL_BYTES * F.size("calls")
    return (per_sample.join(sizes, "map_name")
            .select(*UPLOAD_SAMPLE, "n_snp", "n_called", F.when(dense, _digits("calls", "n_snp")).alias("genotype"),
                    F.when(~dense, F.col("calls")).alias("calls")))


def _digits(calls: str, n_snp: str):
    """The digit string of sorted (pos, code) structs."""
    # fragment i = '5' * (gap before pos_i) + code_i ; then pad to the map size
    body = F.array_join(F.transform(
        calls,
        lambda x, i: F.concat(
            F.repeat(F.lit(MISSING_DIGIT),
                     (x["pos"] - F.coalesce(F.get(F.col(calls), i - 1)["pos"], F.lit(-1)) - 1)
                     .cast("int")),
            x["code"].cast("string"))), "")
    last_pos = F.coalesce(F.get(F.col(calls), F.size(calls) - 1)["pos"], F.lit(-1))
    return F.concat(body, F.repeat(F.lit(MISSING_DIGIT), (F.col(n_snp) - 1 - last_pos).cast("int")))


def spelled(genotype: str = "genotype", calls: str = "calls", n_snp: str = "n_snp"):
    """The digit string of a ``sample_calls`` row."""
    return F.coalesce(genotype, _digits(calls, n_snp))


def genotype_strings(calls: DataFrame, snp_maps: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """(nume_cari, sample_id, map_name, n_snp, n_called, genotype) for every sample of every upload."""
    return (sample_calls(calls, snp_maps, positions)
            .select(*UPLOAD_SAMPLE, "n_snp", "n_called", spelled().alias("genotype")))


def call_rate(n_called, n_snp):
    """Share of called positions, 4 decimals, half-even."""
    return F.bround(F.col(n_called) / F.col(n_snp), 4)


def staging_rows(calls: DataFrame, snp_maps: DataFrame) -> DataFrame:
    """Encoded rows in the staging shape (nume_cari, campione, callrate_g, mappa_usata_g, genotipo)."""
    return staged(genotype_strings(calls, snp_maps))


def staged(g: DataFrame, *more: str) -> DataFrame:
    """The staging shape of ``genotype_strings`` rows, with ``more`` of their columns."""
    return g.select("nume_cari", F.col("sample_id").alias("campione"),
                    call_rate("n_called", "n_snp").alias("callrate_g"),
                    F.col("map_name").alias("mappa_usata_g"), F.col("genotype").alias("genotipo"), *more)


def call_rates(calls: DataFrame, snp_maps: DataFrame) -> DataFrame:
    g = genotype_strings(calls, snp_maps)
    return g.select("nume_cari", F.col("sample_id").alias("campione"), "n_snp", "n_called",
                    call_rate("n_called", "n_snp").alias("call_rate"))


def panel_strings(calls: DataFrame, snp_maps: DataFrame) -> DataFrame:
    g = genotype_strings(calls, snp_maps)
    return g.select("nume_cari", F.col("sample_id").alias("campione"), F.col("genotype").alias("genotipo"))


def allele_errors(calls: DataFrame) -> DataFrame:
    """Per upload: lines whose Allele1 / Allele2 is outside {A, B, -}."""
    return calls.groupBy("nume_cari").agg(
        F.sum(F.when(~allele_ok(F.col("a1")) | F.col("a1").isNull(), 1).otherwise(0)).cast("long").alias("n_bad_a1"),
        F.sum(F.when(~allele_ok(F.col("a2")) | F.col("a2").isNull(), 1).otherwise(0)).cast("long").alias("n_bad_a2"),
        F.count(F.lit(1)).alias("n_lines"))


def missing_snps(calls: DataFrame, snp_maps: DataFrame) -> DataFrame:
    """Map SNPs (upper-cased) that no line of the upload names; per upload, not per sample."""
    positions = map_positions(snp_maps)
    # per upload the set of seen positions, at most one map long; only missing ones become rows
    seen = (calls.select("nume_cari", "map_name", F.upper("snp_name").alias("snp_key")).distinct()
            .join(positions.select("map_name", "snp_key", "pos"), ["map_name", "snp_key"], "left")
            .groupBy("nume_cari", "map_name").agg(F.collect_set("pos").alias("seen")))
    absent = F.array_except(F.sequence(F.lit(0), F.col("n_snp") - 1), "seen")
    return (seen.join(map_sizes(positions), "map_name")
            .select("nume_cari", "map_name", F.explode(absent).alias("pos"))
            .join(positions.select("map_name", "pos", "snp_key"), ["map_name", "pos"])
            .select("nume_cari", "map_name", F.col("snp_key").alias("snp_name"), "pos"))


def unmapped_snps(calls: DataFrame, snp_maps: DataFrame) -> DataFrame:
    """Distinct upper names per upload that are outside the map or had an undecodable pair."""
    positions = map_positions(snp_maps)
    pc = positioned_calls(calls, positions)
    return (pc.where(F.col("pos").isNull() | F.col("code").isNull())
            .groupBy("nume_cari", "map_name", "snp_key")
            .agg(F.max(F.col("pos").isNull()).alias("outside")).select(
                "nume_cari", "map_name", F.col("snp_key").alias("snp_name"),
                F.when(F.col("outside"), "not_in_map").otherwise("undecodable").alias("reason")))


def sample_qc(calls: DataFrame, snp_maps: DataFrame, positions: DataFrame | None = None,
              rates: DataFrame | None = None) -> DataFrame:
    """QC line per sample: map size, missing SNPs and unmapped SNPs of its file, call rate, map.

    ``rates`` are the ``sample_calls`` rows of the same calls, where they are there already.
    """
    if positions is None:
        positions = map_positions(snp_maps)
    if rates is None:
        rates = sample_calls(calls, snp_maps, positions)
    # one pass per file: its distinct names, whether each has a position and a decodable pair
    per_file = ["nume_cari", "map_name"]
    names = positioned_calls(calls, positions).groupBy(*per_file, "snp_key").agg(
        F.max("pos").alias("pos"), F.max(F.col("pos").isNull() | F.col("code").isNull()).alias("bad"))
    files = stored(names.groupBy(*per_file).agg(
        F.count("pos").alias("n_seen"), F.sum(F.col("bad").cast("long")).alias("n_not_in_map")), "file-qc")
    return (rates.join(files, per_file)
            .select("nume_cari", F.col("sample_id").alias("campione"), "n_snp",
                    (F.col("n_snp") - F.col("n_seen")).alias("n_missing"), "n_not_in_map",
                    call_rate("n_called", "n_snp").alias("call_rate"),
                    F.col("map_name").alias("mappa_usata")))


def with_panel(samples: DataFrame, panel: DataFrame) -> DataFrame:
    """Staging rows of ``sample_calls`` with the panel string (left join on the key) of others.

    The strings, as long as their map, are made after the join: what it sorts and holds grows with the calls.
    """
    p = panel.select("nume_cari", "sample_id", *[F.col(c).alias(f"panel_{c}") for c in ("n_snp", "genotype", "calls")])
    joined = samples.join(p, ["nume_cari", "sample_id"], "left")
    rows = joined.withColumns({"genotype": spelled(), "genotipo_parentela": F.when(
        F.col("panel_n_snp").isNotNull(), spelled("panel_genotype", "panel_calls", "panel_n_snp"))})
    return staged(rows, "genotipo_parentela")
