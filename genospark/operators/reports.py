"""Genotype-report shape checks and map resolution, for all uploads at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.session import stored

KEY = "nume_cari"


def rows_per_sample(calls: DataFrame) -> DataFrame:
    return calls.groupBy(KEY, "sample_id").agg(F.count(F.lit(1)).alias("n_rows"))


def sample_counts(calls: DataFrame) -> DataFrame:
    """Per upload: samples, min/max rows per sample, uniformity, chip size = rows / samples,
    and the number of short lines (a missing field), all from one pass over the calls."""
    bad = (F.col("sample_id").isNull() | F.col("snp_name").isNull()
           | F.col("a1").isNull() | F.col("a2").isNull())
    per = calls.groupBy(KEY, "sample_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(bad, 1).otherwise(0)).alias("n_short"))
    agg = per.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("n_rows").alias("n_rows"),
        F.min("n_rows").alias("min_rows"), F.max("n_rows").alias("max_rows"),
        F.sum("n_short").alias("n_short"))
    return agg.select(
        KEY, "n_samples", "n_rows", "min_rows", "max_rows", "n_short",
        (F.col("min_rows") == F.col("max_rows")).alias("is_uniform"),
        F.when(F.col("n_samples") > 0, F.expr("n_rows div n_samples")).alias("chip_size"))


def distinct_snps(calls: DataFrame) -> DataFrame:
    """Distinct SNP names of each report (exact case)."""
    return calls.select(KEY, "snp_name").distinct()


def snp_counts(calls: DataFrame) -> DataFrame:
    return distinct_snps(calls).groupBy(KEY).agg(F.count(F.lit(1)).alias("n_report_snps"))


def _last_map(catalog: DataFrame, on: str, value_col: str, out: str) -> DataFrame:
    """catalogue rows matching ``on``; the last row wins (catalogue order = map_name)."""
    return catalog.groupBy(F.col(on).alias(value_col)).agg(F.max("map_name").alias(out))


def map_by_alias(layout: DataFrame, catalog: DataFrame) -> DataFrame:
    chip = layout.where(F.col("chip").isNotNull()).select(KEY, "chip")
    by_alias = _last_map(catalog, "map_alias", "chip", "map_name")
    return chip.join(F.broadcast(by_alias), "chip", "left").select(KEY, "chip", "map_name")


def map_by_count(sizes: DataFrame, catalog: DataFrame, size_col: str = "chip_size") -> DataFrame:
    by_count = _last_map(catalog, "number_snp", "_n", "map_name")
    s = sizes.select(KEY, F.col(size_col).cast("int").alias("_n"))
    return s.join(F.broadcast(by_count), "_n", "left").select(
        KEY, F.col("_n").alias(size_col), "map_name")


def resolve_maps(layout: DataFrame, counts: DataFrame, snp_n: DataFrame, catalog: DataFrame) -> DataFrame:
    """Map used by each upload.

    With a chip name: the map whose alias is the chip; failing that, the map
    whose size equals the number of distinct SNP names of the report, flagged
    for an alias update.  Without a chip name: the map whose size equals
    rows / samples.  A catalogue column ``since`` names the upload of the same batch
    that registers the map: only later uploads see it.
    """
    by_alias = _last_map(catalog, "map_alias", "chip", "alias_map")
    base = (layout.select(KEY, "chip").join(counts.select(KEY, "chip_size"), KEY, "left")
            .join(snp_n, KEY, "left")
            .withColumn("_n", F.when(F.col("chip").isNotNull(), F.col("n_report_snps"))
                        .otherwise(F.col("chip_size")).cast("int")))
    base = stored(base, "lookups")
    same = catalog.select(F.col("number_snp").alias("_n"), "map_name",
                          F.col("since") if "since" in catalog.columns else F.lit(None).cast("long").alias("since"))
    by_count = (base.select(KEY, "_n").join(same, "_n").where(F.col("since").isNull() | (F.col("since") < F.col(KEY)))
                .groupBy(KEY).agg(F.max("map_name").alias("count_map")))
    r = base.join(F.broadcast(by_alias), "chip", "left").join(by_count, KEY, "left")
    has_chip = F.col("chip").isNotNull()
    return r.select(
        KEY, "chip",
        F.when(has_chip, F.coalesce("alias_map", "count_map")).otherwise(F.col("count_map")).alias("map_name"),
        F.when(has_chip & F.col("alias_map").isNotNull(), "alias")
         .when(F.col("count_map").isNotNull(), "count").alias("resolved_by"),
        (has_chip & F.col("alias_map").isNull() & F.col("count_map").isNotNull()).alias("alias_update"),
        F.col("_n").alias("lookup_size"))


def map_consistency(calls: DataFrame, resolved: DataFrame, snp_maps: DataFrame) -> DataFrame:
    """Exact-name set equality of each report's SNPs and its resolved map.

    n_outer (size of the full outer join) = n_report + n_map - n_matched;
    consistent when it equals both sizes.
    """
    assigned = resolved.where(F.col("map_name").isNotNull()).select(KEY, "map_name")
    rep = distinct_snps(calls).join(assigned, KEY)
    used = snp_maps.join(assigned.select("map_name").distinct(), "map_name", "left_semi")
    mdist = used.select("map_name", "snp_name").distinct()
    n_map = mdist.groupBy("map_name").agg(F.count(F.lit(1)).alias("n_map_snps"))
    matched = (rep.join(mdist.withColumn("hit", F.lit(1)), ["map_name", "snp_name"], "left")
               .groupBy(KEY, "map_name").agg(F.count(F.lit(1)).alias("n_report_snps"),
                                             F.count("hit").alias("n_matched")))
    out = assigned.join(matched, [KEY, "map_name"], "left").join(n_map, "map_name", "left")
    out = out.select(KEY, "map_name",
                     F.coalesce("n_report_snps", F.lit(0)).alias("n_report_snps"),
                     F.coalesce("n_map_snps", F.lit(0)).alias("n_map_snps"),
                     F.coalesce("n_matched", F.lit(0)).alias("n_matched"))
    out = out.withColumn("n_outer", F.col("n_report_snps") + F.col("n_map_snps") - F.col("n_matched"))
    return out.withColumn("consistent", (F.col("n_outer") == F.col("n_report_snps"))
                          & (F.col("n_outer") == F.col("n_map_snps")))
