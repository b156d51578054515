"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the fixtures of ``genospark.plans.fixtures`` (derived from the
TESTDATA tables); column names match the oracle SQL of
``genospark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.operators import encode
from genospark.plans.fixtures import Fixtures
from genospark.session import stored
from genospark.schemas import PANEL_MAP

MAIN_MAP = "MAIN_a"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def _calls_for(fx: Fixtures, map_name: str) -> DataFrame:
    return fx.fx_calls.withColumn("map_name", F.lit(map_name))


def _map(fx: Fixtures, map_name: str) -> DataFrame:
    return fx.fx_snp_map.where(F.col("map_name") == map_name)


# --------------------------------------------------------------------------
# Encoding (q23 - q32)
# --------------------------------------------------------------------------

@query("q23")
def q23_allele_errors(spark, sf_dir):
    return encode.allele_errors(Fixtures(spark, sf_dir).fx_calls)


@query("q24")
def q24_decoded_calls(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.decoded_calls(fx.fx_calls).select(
        "nume_cari", "line_no", "sample_id", "snp_name",
        F.concat("a1", "a2").alias("pair"), "code")


@query("q25")
def q25_last_call(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    positions = encode.map_positions(_map(fx, MAIN_MAP))
    return encode.last_calls(_calls_for(fx, MAIN_MAP), positions).select(
        "nume_cari", "sample_id", "pos", "code", "line_no")


@query("q26")
def q26_missing_snps(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.missing_snps(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP)).select(
        "nume_cari", "snp_name", "pos")


@query("q27")
def q27_unmapped_snps(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.unmapped_snps(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP)).select(
        "nume_cari", "snp_name", "reason")


@query("q28")
def q28_genotype_strings(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.staging_rows(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP))


@query("q29")
def q29_call_rates(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.call_rates(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP))


@query("q30")
def q30_sample_qc(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.sample_qc(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP))


@query("q31")
def q31_panel_strings(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return encode.panel_strings(_calls_for(fx, PANEL_MAP), _map(fx, PANEL_MAP))


@query("q32")
def q32_staging_with_panel(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    # stored, so that the files of its shuffles are gone before those of the samples come
    panel = stored(encode.sample_calls(_calls_for(fx, PANEL_MAP), _map(fx, PANEL_MAP)), "panel-calls", "zstd")
    samples = encode.sample_calls(_calls_for(fx, MAIN_MAP), _map(fx, MAIN_MAP))
    return encode.with_panel(samples, panel)


# --------------------------------------------------------------------------
# Queue (q01 - q03)
# --------------------------------------------------------------------------

from genospark.operators import maps, outcomes, parse, queue, reconcile, reports  # noqa: E402
from genospark.plans import pipeline  # noqa: E402


def _catalog_snp_maps(fx: Fixtures) -> DataFrame:
    """SNP lists of the catalogued maps plus the fixture main and panel maps."""
    cat = fx.fx_map_catalog.select("map_name", "map_alias")
    listed = fx.fx_map_snps.join(cat, "map_alias").select("map_name", "id", "snp_name")
    return listed.unionByName(fx.fx_snp_map.select("map_name", "id", "snp_name"))


@query("q01")
def q01_pending(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return queue.in_order(queue.pending(fx.fx_jobs).select(*queue.QUEUE_COLS))


@query("q02")
def q02_file_names(spark, sf_dir):
    return queue.file_names(queue.pending(Fixtures(spark, sf_dir).fx_jobs))


@query("q03")
def q03_type_check(spark, sf_dir):
    return queue.route(queue.pending(Fixtures(spark, sf_dir).fx_jobs))


# --------------------------------------------------------------------------
# Parsing (q04, q05, q13 - q15)
# --------------------------------------------------------------------------

@query("q04")
def q04_separator(spark, sf_dir):
    lay = parse.report_layout(Fixtures(spark, sf_dir).fx_raw_lines)
    return lay.select("nume_cari", "sep", "header_line_no")


@query("q05")
def q05_map_records(spark, sf_dir):
    lines = Fixtures(spark, sf_dir).fx_map_lines
    return parse.map_records(lines, stored(parse.map_layout(lines)))


@query("q13")
def q13_report_calls(spark, sf_dir):
    lines = Fixtures(spark, sf_dir).fx_raw_lines
    return parse.report_calls(lines, stored(parse.report_layout(lines)))


@query("q14")
def q14_chip(spark, sf_dir):
    lay = parse.report_layout(Fixtures(spark, sf_dir).fx_raw_lines)
    return lay.select("nume_cari", "chip")


@query("q15")
def q15_required_columns(spark, sf_dir):
    lay = parse.report_layout(Fixtures(spark, sf_dir).fx_raw_lines)
    return lay.select("nume_cari", "sep", F.col("i_a1").isNotNull().alias("has_a1"),
                      F.col("i_a2").isNotNull().alias("has_a2"), F.col("has_alleles").alias("columns_ok"))


# --------------------------------------------------------------------------
# Maps (q06 - q12)
# --------------------------------------------------------------------------

@query("q06")
def q06_duplicates(spark, sf_dir):
    c = maps.name_checks(Fixtures(spark, sf_dir).fx_new_map)
    return c.select("upload_id", "n_rows", "n_distinct", "has_dup")


@query("q07")
def q07_blanks(spark, sf_dir):
    return maps.name_checks(Fixtures(spark, sf_dir).fx_new_map).select("upload_id", "n_blank")


@query("q08")
def q08_map_verdict(spark, sf_dir):
    c = maps.name_checks(Fixtures(spark, sf_dir).fx_new_map)
    return c.select("upload_id", F.col("n_rows").alias("n_snp"), "verdict")


def _checked_new(fx: Fixtures):
    records = fx.fx_new_map  # already a stored fixture table
    return records, stored(maps.name_checks(records))


@query("q09")
def q09_same_size(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return maps.same_size_maps(maps.name_checks(fx.fx_new_map), fx.fx_map_catalog)


@query("q10")
def q10_identical(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    records, checks = _checked_new(fx)
    valid = records.join(checks.where(F.col("verdict") == "ok").select("upload_id"), "upload_id", "left_semi")
    return maps.identical_maps(valid, fx.fx_map_catalog, _catalog_snp_maps(fx))


@query("q11")
def q11_next_name(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    records, checks = _checked_new(fx)
    return maps.name_uploads(records, checks, fx.fx_map_catalog, _catalog_snp_maps(fx))


@query("q12")
def q12_map_outcomes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    mb = pipeline.map_batch(fx.fx_map_lines, fx.fx_map_catalog, _catalog_snp_maps(fx), store_lines=False)
    return outcomes.decode(mb.outcomes).select("upload_id", "code", "map_name", "n_snp", "bit_ok",
                                               "bit_elaborato", "errori_elab")


# --------------------------------------------------------------------------
# Report checks and map resolution (q16 - q22)
# --------------------------------------------------------------------------

def _parsed_calls(fx: Fixtures):
    lines = fx.fx_raw_lines  # a stored fixture table
    lay = stored(parse.report_layout(lines))
    return lay, stored(parse.report_calls(lines, lay))


@query("q16")
def q16_rows_per_sample(spark, sf_dir):
    _, calls = _parsed_calls(Fixtures(spark, sf_dir))
    return reports.rows_per_sample(calls)


@query("q17")
def q17_uniform(spark, sf_dir):
    _, calls = _parsed_calls(Fixtures(spark, sf_dir))
    return reports.sample_counts(calls).select("nume_cari", "n_samples", "min_rows", "max_rows", "is_uniform")


@query("q18")
def q18_chip_size(spark, sf_dir):
    _, calls = _parsed_calls(Fixtures(spark, sf_dir))
    return reports.sample_counts(calls).select("nume_cari", "n_rows", "n_samples", "chip_size")


@query("q19")
def q19_map_by_alias(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lay, _ = _parsed_calls(fx)
    return reports.map_by_alias(lay, fx.fx_map_catalog)


@query("q20")
def q20_map_by_count(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    _, calls = _parsed_calls(fx)
    return reports.map_by_count(reports.sample_counts(calls), fx.fx_map_catalog)


@query("q21")
def q21_alias_updates(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lay, calls = _parsed_calls(fx)
    return reports.resolve_maps(lay, reports.sample_counts(calls), reports.snp_counts(calls), fx.fx_map_catalog)


@query("q22")
def q22_map_consistency(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    assigned = fx.fx_calls.select("nume_cari").distinct().withColumn("map_name", F.lit(MAIN_MAP))
    main = reports.map_consistency(fx.fx_calls, assigned, fx.fx_snp_map)
    lay, calls = _parsed_calls(fx)
    resolved = reports.resolve_maps(lay, reports.sample_counts(calls), reports.snp_counts(calls), fx.fx_map_catalog)
    return main.unionByName(reports.map_consistency(calls, resolved, _catalog_snp_maps(fx)))


# --------------------------------------------------------------------------
# Reconciliation, outcomes, status (q33 - q38)
# --------------------------------------------------------------------------

@query("q33")
def q33_not_in_archive(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return reconcile.not_in_archive(reconcile.report_samples(fx.fx_calls), fx.fx_archive)


@query("q34")
def q34_staged_samples(spark, sf_dir):
    return reconcile.staged_samples(Fixtures(spark, sf_dir).fx_staging)


@query("q35")
def q35_long_ids(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return reconcile.long_ids(reconcile.report_samples(_parsed_calls(fx)[1]))


@query("q36")
def q36_summary(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return pipeline.reconciliation(_parsed_calls(fx)[1], fx.fx_archive, fx.fx_staging)


def _genotype_batch(fx: Fixtures):
    return pipeline.genotype_batch(fx.fx_raw_lines, fx.fx_map_catalog, _catalog_snp_maps(fx), store_lines=False)


@query("q37")
def q37_genotype_outcomes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = pipeline.genotype_outcomes(_genotype_batch(fx))
    return outcomes.decode(out).select("nume_cari", "code", "map_name", "bit_ok", "bit_elaborato", "errori_elab")


@query("q38")
def q38_upload_status(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    typed = queue.route(queue.pending(fx.fx_jobs)).where(F.col("type_code").isNotNull()).select(
        "nume_cari", F.col("type_code").alias("code"))
    gb = _genotype_batch(fx)
    summaries = pipeline.reconciliation(gb.calls, fx.fx_archive, gb.staging.select("nume_cari", "campione"))
    geno = outcomes.status_rows(pipeline.genotype_outcomes(gb).select("nume_cari", "code"), summaries)
    mb = pipeline.map_batch(fx.fx_map_lines, fx.fx_map_catalog, _catalog_snp_maps(fx), store_lines=False)
    mapped = outcomes.status_rows(mb.outcomes.select(F.col("upload_id").alias("nume_cari"), "code"))
    return outcomes.status_rows(typed).unionByName(geno).unionByName(mapped)


# --------------------------------------------------------------------------
# Population-genetics extensions (x01 - x09)
# --------------------------------------------------------------------------

from genospark.operators import popgen  # noqa: E402


def _cells(fx: Fixtures):
    """Winning calls of every sample against the main map, stored once (read by several branches)."""
    positions = encode.map_positions(_map(fx, MAIN_MAP))
    cells = stored(encode.last_calls(_calls_for(fx, MAIN_MAP), positions))
    return cells, stored(positions)


def _freqs(fx: Fixtures):
    cells, positions = _cells(fx)
    return cells, positions, popgen.allele_frequencies(cells, positions)


@query("x01")
def x01_allele_frequency(spark, sf_dir):
    _, _, fr = _freqs(Fixtures(spark, sf_dir))
    return fr.select("map_name", "pos", "snp_name", "n0", "n1", "n2", "n_called", "p_a", "maf", "informative")


@query("x02")
def x02_snp_call_rate(spark, sf_dir):
    _, _, fr = _freqs(Fixtures(spark, sf_dir))
    return fr.select("map_name", "pos", "snp_name", "n_called", "n_samples", "call_rate")


@query("x03")
def x03_opposing_homozygotes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cells, _ = _cells(fx)
    return popgen.opposing_homozygotes(cells, fx.fx_pedigree).drop("map_name")


@query("x04")
def x04_parent_verdict(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cells, _ = _cells(fx)
    return popgen.parent_verdicts(cells, fx.fx_pedigree).drop("map_name")


@query("x05")
def x05_exclusion(spark, sf_dir):
    _, _, fr = _freqs(Fixtures(spark, sf_dir))
    return popgen.exclusion_probability(fr)


@query("x06")
def x06_likelihood(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cells, _, fr = _freqs(fx)
    return popgen.likelihood_ratios(cells, stored(fr), fx.fx_pedigree).drop("map_name")


@query("x07")
def x07_ancestors(spark, sf_dir):
    return popgen.ancestors(Fixtures(spark, sf_dir).fx_pedigree)


@query("x08")
def x08_half_sibs(spark, sf_dir):
    return popgen.sibling_counts(Fixtures(spark, sf_dir).fx_pedigree)


@query("x09")
def x09_fst(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cells, positions = _cells(fx)
    return popgen.fst(cells, positions)


# --------------------------------------------------------------------------
# Parent search and assignment on the derived families (x10 - x13)
# --------------------------------------------------------------------------

from genospark.operators import parentage  # noqa: E402

#: Conflicts that the families' planted errors cause, and SNPs that a comparison needs.
FAMILY_CONFLICTS, FAMILY_SNPS = 0.03, 20


def _with_frequencies(calls, name: str):
    """The calls as stored rows of samples, which every step reads in place of the calls, and their frequencies."""
    cells = popgen.sample_rows(calls)
    positions = popgen.seen_positions(cells).withColumn("snp_key", F.col("pos").cast("string"))
    return cells, stored(popgen.allele_frequencies(cells, positions), name)


def _family(fx: Fixtures):
    return _with_frequencies(fx.fx_family_calls, "family-frequencies")


def _found_parents(fx: Fixtures, cells):
    return parentage.parent_search(cells, fx.fx_family_pedigree, FAMILY_CONFLICTS, FAMILY_SNPS)


def _assigned(fx: Fixtures):
    cells, freqs = _family(fx)
    possible = parentage.possible_parents(cells, fx.fx_family_pedigree, _found_parents(fx, cells), FAMILY_CONFLICTS)
    return freqs, parentage.assign_parents(cells, freqs, possible)


@query("x10")
def x10_parent_search(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _found_parents(fx, popgen.sample_rows(fx.fx_family_calls)).drop("map_name")


@query("x11")
def x11_parent_assignment(spark, sf_dir):
    return _assigned(Fixtures(spark, sf_dir))[1].drop("map_name")


@query("x12")
def x12_error_rates(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cells, freqs = _family(fx)
    # eight rounds for every SNP, as the SQL has; by default a SNP's rounds end with its gain
    rates = parentage.error_rates(cells, freqs, fx.fx_family_pedigree, rounds=8, gain=-1.0)
    return rates.select("pos", "n_trios", F.round("rate", 8).alias("rate"),
                        F.round("first_log_likelihood", 6).alias("first_log_likelihood"),
                        F.round("log_likelihood", 6).alias("log_likelihood"), "rounds")


@query("x13")
def x13_assignment_confidence(spark, sf_dir):
    freqs, assigned = _assigned(Fixtures(spark, sf_dir))
    (p, ) = popgen.frequencies_by_map(freqs).values()
    return parentage.confident(assigned, parentage.critical_differences(spark, p)).select(
        "child", "parent_1", "parent_2", "delta", "confidence")


# --------------------------------------------------------------------------
# Pedigree on the derived lineage (x14 - x16)
# --------------------------------------------------------------------------

from genospark.operators import pedigree as lineage  # noqa: E402


@query("x14")
def x14_pedigree_contradictions(spark, sf_dir):
    return lineage.contradictions(Fixtures(spark, sf_dir).fx_lineage)


@query("x15")
def x15_inbreeding(spark, sf_dir):
    members = lineage.coefficients(Fixtures(spark, sf_dir).fx_lineage).members
    return members.select("sample", "generation", F.round("inbreeding", 10).alias("inbreeding"))


@query("x16")
def x16_relationship(spark, sf_dir):
    records = Fixtures(spark, sf_dir).fx_lineage
    found = lineage.coefficients(records).relationships(lineage.recorded_pairs(records))
    return found.withColumn("relationship", F.round("relationship", 10))


@query("x17")
def x17_hardy_weinberg(spark, sf_dir):
    _, _, fr = _freqs(Fixtures(spark, sf_dir))
    return popgen.hardy_weinberg(fr).select("map_name", "pos", "snp_name", "n0", "n1", "n2",
                                            F.round("p_value", 9).alias("p_value"), F.round("f", 6).alias("f"))


# --------------------------------------------------------------------------
# Substructure and panel choice on the derived populations (x18 - x21)
# --------------------------------------------------------------------------

from genospark.operators import linkage, structure  # noqa: E402


def _population(fx: Fixtures):
    return _with_frequencies(fx.fx_population_calls, "population-frequencies")


@query("x18")
def x18_principal_components(spark, sf_dir):
    cells, freqs = _population(Fixtures(spark, sf_dir))
    found = structure.principal_components(cells, freqs, k=1)
    return found.scores.join(found.axes.where("component = 1"), "map_name").select(
        "sample_id", F.round(F.col("scores")[0], 4).alias("score"), F.round("variance", 4).alias("variance"),
        F.round("share", 6).alias("share"))


@query("x19")
def x19_group_exclusion(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return structure.group_exclusion(popgen.sample_rows(fx.fx_population_calls), fx.fx_ancestry).select(
        "sample_id", "n_snps", F.round("pe_combined", 6).alias("pe_combined"))


@query("x20")
def x20_group_likelihood(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return structure.group_likelihood_ratios(popgen.sample_rows(fx.fx_population_calls), fx.fx_ancestry, fx.fx_pedigree).select(
        "child", "parent", "role", "n_snps", F.round("lod", 4).alias("lod"))


@query("x21")
def x21_pruned_panel(spark, sf_dir):
    cells, freqs = _population(Fixtures(spark, sf_dir))
    return linkage.pruned_panel(cells, freqs, window=20).drop("map_name", "snp_name")


# --------------------------------------------------------------------------
# Streaming queue (s01, s02)
# --------------------------------------------------------------------------

import os  # noqa: E402

from genospark.plans.commits import Published  # noqa: E402
from genospark.session import scratch_path  # noqa: E402
from genospark.sources.zipfiles import list_archives  # noqa: E402
from genospark.plans import sinks  # noqa: E402
from genospark.streaming import queue_stream, queue_table  # noqa: E402


def _stream_once(spark, sf_dir):
    """Write the fixture queue as several files, stream it with availableNow, return the status log."""
    fx = Fixtures(spark, sf_dir)
    base = scratch_path(spark, "queue")
    queue_dir, status_dir = os.path.join(base, "queue"), os.path.join(base, "status")
    jobs = fx.fx_jobs
    jobs.repartition(4, "nume_cari").write.parquet(queue_dir)
    files = list_archives(spark, os.path.join(base, "uploads"))
    queue_stream.run_queue(spark, queue_dir, jobs.schema, status_dir, os.path.join(base, "checkpoint"), files)
    return fx, queue_stream.read_status(spark, status_dir)


@query("s01")
def s01_queue_stream(spark, sf_dir):
    _, status = _stream_once(spark, sf_dir)
    return status.select("nume_cari", "code", "bit_ok", "bit_elaborato", "errori_elab")


@query("s02")
def s02_retry(spark, sf_dir):
    fx, status = _stream_once(spark, sf_dir)
    return queue_stream.retry_set(fx.fx_jobs, status).select("nume_cari", "tipo_cari", "nome_file")


@query("s03")
def s03_published_batches(spark, sf_dir):
    """Early outcomes of the queue in two batches; of each the first attempt is lost before its commit."""
    fx = Fixtures(spark, sf_dir)
    typed = queue.route(queue.pending(fx.fx_jobs)).where(F.col("type_code").isNotNull()).select(
        "nume_cari", F.col("type_code").alias("code"))
    status = outcomes.status_rows(typed)
    published = Published(spark, scratch_path(spark, "published"))
    for k in range(2):
        rows = status.where(F.pmod(F.col("nume_cari").cast("long"), F.lit(2)) == k)
        published.begin(f"half {k}").write("status", rows)
        attempt = published.begin(f"half {k}")
        attempt.write("status", rows)
        attempt.commit()
    return published.read("status", "nume_cari").drop("batch", "seq")


@query("s04")
def s04_queue_table(spark, sf_dir):
    """The queue table as a source, in two runs from one checkpoint; the rows of the second came late, under smaller ids too."""
    fx = Fixtures(spark, sf_dir)
    base = scratch_path(spark, "queue-table")
    table, status_dir = os.path.join(base, "queue"), os.path.join(base, "status")
    jobs, files = fx.fx_jobs, list_archives(spark, os.path.join(base, "uploads"))
    for k in range(2):
        jobs.where(F.pmod("nume_cari", F.lit(2)) == k).repartition(2).write.mode("append").parquet(table)
        queue_stream.run_queue(spark, table, jobs.schema, status_dir, os.path.join(base, "checkpoint"), files,
                               stream=queue_table.queue_table(spark, table, jobs.schema))
    status = sinks.latest_status(queue_stream.read_status(spark, status_dir))
    return status.select("nume_cari", "code", "bit_ok", "bit_elaborato", "errori_elab")
