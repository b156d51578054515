"""Batch pipeline: chains the operators for all pending uploads at once.

queue -> lines -> {map records | report calls} -> verdicts -> encode ->
staging -> reconcile -> status.  Every step is a DataFrame function keyed by
the upload; nothing is looped over on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators import encode, maps, outcomes, parse, reconcile, reports
from genospark.schemas import PANEL_MAP
from genospark.session import stored

KEY = "nume_cari"


_QC = (KEY + " {}, campione string, n_snp int, n_missing long, n_not_in_map long, call_rate double, "
       "mappa_usata string")


def _empty_staging(calls: DataFrame) -> DataFrame:
    key_type = calls.schema[KEY].dataType.simpleString()
    return calls.sparkSession.createDataFrame(
        [], f"{KEY} {key_type}, campione string, callrate_g double, mappa_usata_g string, "
            "genotipo string, genotipo_parentela string")


@dataclass
class GenotypeBatch:
    layout: DataFrame
    calls: DataFrame
    flags: DataFrame
    staging: DataFrame
    qc: DataFrame              # one line per encoded sample


def genotype_batch(lines: DataFrame, catalog: DataFrame, snp_maps: DataFrame,
                   panel_map: str = PANEL_MAP, store_lines: bool = True) -> GenotypeBatch:
    """Parse, check, resolve and encode every report upload of ``lines``.

    ``lines``: (nume_cari, line_no, line).  Returns the per-upload flags (one
    row per upload, input of ``outcomes.genotype_code``) and the staging rows
    (main-map string, call rate and panel string) of the uploads that pass.
    """
    # lines, layout and calls are each stored once in the shared checkpoint
    # folder: every later check reads stored rows instead of re-reading input
    if store_lines:  # e.g. lines decompressed from zip files: read them once
        lines = stored(lines, "lines")
    layout = stored(parse.report_layout(lines))
    calls = stored(parse.report_calls(lines, layout))
    counts = reports.sample_counts(calls)
    snp_n = reports.snp_counts(calls)
    resolved = reports.resolve_maps(layout, counts, snp_n, catalog)
    consistency = reports.map_consistency(calls, resolved, snp_maps).select(KEY, "consistent")
    pre = (layout.select(KEY, "first_line", "sep", "has_alleles")
           .withColumn("type_code", outcomes.type_code(F.lit("G"), F.col("first_line")))
           .join(counts.select(KEY, "n_samples", "is_uniform", "n_short"), KEY, "left")
           .join(resolved.select(KEY, "map_name", "alias_update"), KEY, "left")
           .join(consistency, KEY, "left")
           .withColumn("n_short", F.coalesce("n_short", F.lit(0)))
           .withColumn("n_encoded", F.col("n_samples")))
    pre = stored(pre)
    eligible = pre.where(outcomes.genotype_code().isin("g_I", "g_K")).select(KEY, "map_name")
    panel_ready, qc = True, None
    if eligible.isEmpty():  # one small read of the stored per-upload table
        staging = _empty_staging(calls)
    else:
        panel_snps = snp_maps.where(F.col("map_name") == panel_map)
        panel_ready = not panel_snps.isEmpty()  # one-row read
        main_calls = calls.join(eligible, KEY)  # stored per-upload table: broadcast from its file size
        used_maps = snp_maps.join(eligible.select("map_name").distinct(), "map_name", "left_semi")
        positions = encode.map_positions(used_maps)
        # read by staging and QC: every call is encoded once
        encoded = stored(encode.sample_calls(main_calls, used_maps, positions), "encoded")
        panel_calls = calls.join(eligible.select(KEY), KEY, "left_semi").withColumn("map_name", F.lit(panel_map))
        panel = encode.sample_calls(panel_calls, panel_snps)
        staging = stored(encode.with_panel(encoded, panel)) if panel_ready else _empty_staging(calls)
        qc = stored(encode.sample_qc(main_calls, used_maps, positions, encoded), "qc")
    if not panel_ready:  # these uploads cannot be finished now: they stay pending
        pre = pre.withColumn("type_code", F.when(outcomes.genotype_code().isin("g_I", "g_K"), "c_B")
                             .otherwise(F.col("type_code")))
    n_enc = staging.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_staged"))
    flags = (pre.join(n_enc, KEY, "left")
             .withColumn("n_encoded", F.when(outcomes.genotype_code().isin("g_I", "g_K"),
                                             F.coalesce("n_staged", F.lit(0))).otherwise(F.col("n_samples")))
             .drop("n_staged"))
    if qc is None:
        qc = calls.sparkSession.createDataFrame([], _QC.format(calls.schema[KEY].dataType.simpleString()))
    return GenotypeBatch(layout, calls, flags, staging, qc)


def genotype_outcomes(batch: GenotypeBatch) -> DataFrame:
    return batch.flags.select(KEY, outcomes.genotype_code().alias("code"), "map_name")


@dataclass
class MapBatch:
    layout: DataFrame
    records: DataFrame
    outcomes: DataFrame
    catalog_rows: DataFrame
    snp_rows: DataFrame


def map_batch(lines: DataFrame, catalog: DataFrame, snp_maps: DataFrame, key: str = "upload_id",
              store_lines: bool = True) -> MapBatch:
    if store_lines:
        lines = stored(lines, "map_lines")
    layout = stored(parse.map_layout(lines, key))
    records = stored(parse.map_records(lines, layout, key))
    out = maps.map_outcomes(layout, records, catalog, snp_maps, key)
    cat_rows, snp_rows = maps.registrations(out, records, key)
    return MapBatch(layout, records, out, cat_rows, snp_rows)


def reconciliation(calls: DataFrame, archive: DataFrame, staging: DataFrame) -> DataFrame:
    return reconcile.summary(reconcile.report_samples(calls), archive, staging)


@dataclass
class UploadRun:
    status: DataFrame          # (nume_cari, code, bit_ok, bit_elaborato, errori_elab)
    staging: DataFrame         # encoded rows of successful genotype uploads
    names: DataFrame           # output file names per upload
    catalog_rows: DataFrame    # maps registered by this run
    snp_rows: DataFrame
    alias_updates: DataFrame   # (nume_cari, map_name, number_snp, map_alias)
    qc: DataFrame              # QC line per encoded sample
    allele_errors: DataFrame   # bad allele letters per upload
    long_ids: DataFrame        # sample ids over the length limit
    archives: DataFrame        # (nume_cari, path): the archive read for each upload that has one


def process_uploads(queue_df: DataFrame, lines: DataFrame, catalog: DataFrame, snp_maps: DataFrame,
                    archive: DataFrame, panel_map: str = PANEL_MAP) -> UploadRun:
    """Decide every pending upload of ``queue_df`` in one set-based run.

    ``lines`` comes from ``sources.zipfiles.zip_lines`` (path, file_name,
    n_members, status, line_no, line).  Files are matched to queue rows by
    exact stored name.  Rule order before parsing: file absent (c_B maps,
    g_B reports), several members (m_C / g_H), unreadable archive (c_B,
    stays pending), wrong type (c_A).
    """
    from genospark.operators import queue
    from genospark.sources.zipfiles import archive_status

    pend = stored(queue.pending(queue_df), "pending")
    names = queue.file_names(pend)
    wanted = stored(names.select(KEY, "file_name"), "wanted")  # broadcast from its size, else AQE
    mine = stored(lines.join(wanted, "file_name"), "upload_lines")
    arch = archive_status(mine, keys=(KEY,))
    jobs = pend.select(KEY, "tipo_cari").join(arch, KEY, "left")
    is_map = F.col("tipo_cari") == "M"
    pre = (F.when(F.col("status").isNull(), F.when(is_map, "c_B").otherwise("g_B"))
           .when(F.col("status") == "members", F.when(is_map, "m_C").otherwise("g_H"))
           .when(F.col("status") == "corrupt", "c_B")
           .otherwise(outcomes.type_code(F.col("tipo_cari"), F.col("first_line"))))
    jobs = stored(jobs.withColumn("pre_code", pre), "jobs")
    early = jobs.where(F.col("pre_code").isNotNull()).select(KEY, F.col("pre_code").alias("code"))
    go = jobs.where(F.col("pre_code").isNull())
    body = mine.where(F.col("line").isNotNull()).select(KEY, "line_no", "line")  # bad archives have no upload in ``go``
    map_lines = body.join(go.where(is_map).select(KEY), KEY, "left_semi")  # jobs is stored: sized by file
    geno_lines = body.join(go.where(~is_map).select(KEY), KEY, "left_semi")

    mb = map_batch(map_lines, catalog, snp_maps, key=KEY, store_lines=False)
    # a report sees the maps that earlier uploads of the same batch register
    new_rows = stored(mb.catalog_rows, "new-catalogue")
    mapped = catalog.select("map_name", "number_snp", "map_alias", F.lit(None).cast("long").alias("since")).unionByName(
        new_rows.select("map_name", "number_snp", "map_alias", F.col("upload").cast("long").alias("since")))
    new_snps = stored(mb.snp_rows, "new-snps")
    all_snps = snp_maps.select("map_name", "id", "snp_name").unionByName(new_snps.drop("upload"))
    gb = genotype_batch(geno_lines, mapped, all_snps, panel_map, store_lines=False)
    geno_out = genotype_outcomes(gb)
    summaries = reconciliation(gb.calls, archive, gb.staging.select(KEY, "campione"))
    status = (outcomes.status_rows(early)
              .unionByName(outcomes.status_rows(mb.outcomes.select(KEY, "code")))
              .unionByName(outcomes.status_rows(geno_out.select(KEY, "code"), summaries)))
    chips = gb.layout.select(KEY, F.col("chip").alias("map_alias"))
    sizes = mapped.select("map_name", "number_snp")
    alias_updates = (geno_out.where(F.col("code") == "g_K").select(KEY, "map_name")
                     .join(chips, KEY).join(F.broadcast(sizes), "map_name", "left")
                     .select(KEY, "map_name", "number_snp", "map_alias"))
    staging = gb.staging.join(names.select(KEY, "file_name"), KEY)
    return UploadRun(status, staging, names, new_rows, new_snps, alias_updates, gb.qc,
                     encode.allele_errors(gb.calls), reconcile.long_ids(reconcile.report_samples(gb.calls)),
                     mine.groupBy(KEY).agg(F.min("path").alias("path")))
