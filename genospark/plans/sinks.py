"""Writers for the pipeline outputs.

Every write is a distributed writer into a folder (no driver-side rows).
Re-runs are idempotent: partitioned tables use dynamic partition overwrite,
so writing an upload again replaces only that upload's partition; the status
table is append-only and read through ``latest_status``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genospark.plans.named_files import write_named_files
from genospark.schemas import PANEL_SUFFIX


def _dynamic(df: DataFrame):
    """Overwrite only the partitions present in ``df`` (per write, session settings untouched)."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _genotype_lines(staging: DataFrame, names: DataFrame) -> DataFrame:
    return staging.join(names.select("nume_cari", "output_name"), "nume_cari").select(
        "output_name", F.col("campione").alias("Campione"), F.col("callrate_g").alias("CallRate"),
        F.col("mappa_usata_g").alias("mappa_usata"), F.col("genotipo").alias("Genotipo"))


def _panel_lines(staging: DataFrame, names: DataFrame) -> DataFrame:
    return (staging.where(F.col("genotipo_parentela").isNotNull())
            .join(names.select("nume_cari", F.concat("output_name", F.lit(PANEL_SUFFIX)).alias("output_name")),
                  "nume_cari")
            .select("output_name", F.col("campione").alias("Campione"),
                    F.col("genotipo_parentela").alias("Genotipo")))


def write_genotype_files(staging: DataFrame, names: DataFrame, out_dir: str) -> None:
    """K3: ``Campione;CallRate;mappa_usata;Genotipo`` with a header, one file of the output name per upload."""
    write_named_files(_genotype_lines(staging, names), out_dir, "output_name", ["Campione"])


def write_panel_files(staging: DataFrame, names: DataFrame, out_dir: str) -> None:
    """K4: ``Campione;Genotipo`` of the panel strings, file name suffixed with the panel suffix."""
    write_named_files(_panel_lines(staging, names), out_dir, "output_name", ["Campione"])


def write_genotype_csv(staging: DataFrame, names: DataFrame, out_dir: str) -> None:
    """K3 as a table: one folder of part files per output name, which Spark reads back by name."""
    rows = _genotype_lines(staging, names)
    _dynamic(rows).partitionBy("output_name").option("sep", ";").option("header", True).csv(out_dir)


def write_panel_csv(staging: DataFrame, names: DataFrame, out_dir: str) -> None:
    """K4 as a table, like ``write_genotype_csv``."""
    rows = _panel_lines(staging, names)
    _dynamic(rows).partitionBy("output_name").option("sep", ";").option("header", True).csv(out_dir)


def write_staging(staging: DataFrame, path: str) -> None:
    """K5/K6: staging rows (with the panel column) partitioned by upload."""
    _dynamic(staging.repartition("nume_cari")).partitionBy("nume_cari").parquet(path)


def append_status(status: DataFrame, path: str, batch: str | None = None) -> None:
    """K7: status log with the run timestamp and the run date text (yyyy-MM-dd).

    Rows of one batch are one partition: writing a batch again replaces them.
    """
    _dynamic(_dated(status).withColumn("batch", F.lit(batch or uuid.uuid4().hex))).partitionBy("batch").parquet(path)


def _dated(status: DataFrame) -> DataFrame:
    return status.withColumn("run_ts", F.current_timestamp()).withColumn(
        "run_date", F.date_format(F.current_date(), "yyyy-MM-dd"))


def tables_of(run) -> dict[str, DataFrame]:
    """Every output table of an upload run, the status log last."""
    return {"staging": run.staging, "sample_qc": run.qc, "allele_errors": run.allele_errors, "long_ids": run.long_ids,
            "archives": run.archives, "new_catalog": run.catalog_rows, "new_snp_maps": run.snp_rows,
            "alias_updates": run.alias_updates, "status": _dated(run.status)}


def latest_status(status_log: DataFrame) -> DataFrame:
    """Newest status row per upload."""
    w = Window.partitionBy("nume_cari").orderBy(F.col("run_ts").desc())
    return status_log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def register_maps(catalog_rows: DataFrame, snp_rows: DataFrame, catalog_path: str, maps_path: str) -> None:
    """K1/K2: new catalogue and SNP rows, partitioned by the registering upload; running an upload
    again replaces its rows."""
    _dynamic(catalog_rows).partitionBy("upload").parquet(catalog_path)
    _dynamic(snp_rows.repartition("upload")).partitionBy("upload", "map_name").parquet(maps_path)


def append_alias_updates(updates: DataFrame, path: str) -> None:
    """K8: (nume_cari, map_name, number_snp, map_alias) for uploads resolved by size with a new chip name."""
    _dynamic(updates).partitionBy("nume_cari").parquet(path)


def write_checks(qc: DataFrame, allele_errors: DataFrame, long_ids: DataFrame, path: str) -> None:
    """QC line per sample, bad allele letters per upload and over-long sample ids, by upload."""
    for name, df in (("sample_qc", qc), ("allele_errors", allele_errors), ("long_ids", long_ids)):
        _dynamic(df.repartition("nume_cari")).partitionBy("nume_cari").parquet(f"{path}/{name}")
