"""Reconciliation of report samples with the sample archive and the staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genospark.schemas import (MAX_SAMPLE_ID_LENGTH, SUMMARY_FIRST, SUMMARY_LIST_SIZE, SUMMARY_NOT_IN_ARCHIVE,
                               SUMMARY_OVERWRITTEN, SUMMARY_READY)
from genospark.session import stored

KEY = "nume_cari"
WS = " \t\r\n"


def archive_ids(archive: DataFrame, column: str = "chr_codicecampionelab") -> DataFrame:
    """Archive sample ids: nulls dropped, whitespace trimmed at both sides (column pruned at the scan)."""
    return (archive.select(F.col(column)).where(F.col(column).isNotNull())
            .select(F.btrim(F.col(column), F.lit(WS)).alias("sample_id")).distinct())


def report_samples(calls: DataFrame) -> DataFrame:
    return calls.select(KEY, "sample_id").distinct()


def not_in_archive(samples: DataFrame, archive: DataFrame) -> DataFrame:
    return samples.join(archive_ids(archive), "sample_id", "left_anti").select(KEY, "sample_id")


def long_ids(samples: DataFrame, max_len: int = MAX_SAMPLE_ID_LENGTH) -> DataFrame:
    return samples.where(F.length("sample_id") > max_len).select(
        KEY, "sample_id", F.length("sample_id").alias("id_length"))


def staged_samples(staging: DataFrame) -> DataFrame:
    """Staged rows of each upload with spaces removed from the sample id."""
    return staging.select(KEY, F.replace(F.col("campione"), F.lit(" "), F.lit("")).alias("campione"))


def first_k(df: DataFrame, value: str, k: int = SUMMARY_LIST_SIZE, out: str = "first") -> DataFrame:
    """Per upload, the k smallest distinct values joined with ', '.

    ``row_number <= k`` is planned with a partial window-group limit before the
    shuffle, so each upload moves at most k rows per map task.
    """
    d = df.select(KEY, value).distinct()
    w = Window.partitionBy(KEY).orderBy(value)
    top = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return top.groupBy(KEY).agg(F.array_join(F.array_sort(F.collect_list(value)), ", ").alias(out))


def summary(samples: DataFrame, archive: DataFrame, staging: DataFrame) -> DataFrame:
    """One row per upload: counts, first-10 lists and the summary text."""
    # one row per upload, stored: joins against it are broadcast from its file
    # size, so staged rows are never shuffled by upload key
    n_samples = stored(samples.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_samples")), "n_samples")
    missing = not_in_archive(samples, archive)
    n_missing = missing.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_not_in_archive"))
    staged = staged_samples(staging).join(n_samples.select(KEY), KEY, "left_semi")
    n_staged = staged.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_staged"))
    s = (n_samples.join(n_missing, KEY, "left").join(first_k(missing, "sample_id", out="first_not_in_archive"), KEY, "left")
         .join(n_staged, KEY, "left").join(first_k(staged, "campione", out="first_staged"), KEY, "left"))
    s = s.select(KEY, "n_samples",
                 F.coalesce("n_not_in_archive", F.lit(0)).alias("n_not_in_archive"),
                 F.coalesce("first_not_in_archive", F.lit("")).alias("first_not_in_archive"),
                 F.coalesce("n_staged", F.lit(0)).alias("n_staged"),
                 F.coalesce("first_staged", F.lit("")).alias("first_staged"))
    head = F.concat(F.col("n_samples").cast("string"), F.lit(SUMMARY_READY))
    missing_part = F.when(F.col("n_not_in_archive") > 0, F.concat(
        F.col("n_not_in_archive").cast("string"), F.lit(SUMMARY_NOT_IN_ARCHIVE),
        F.lit(SUMMARY_FIRST), F.col("first_not_in_archive"), F.lit("\n"))).otherwise(F.lit(""))
    staged_part = F.when(F.col("n_staged") > 0, F.concat(
        F.col("n_staged").cast("string"), F.lit(SUMMARY_OVERWRITTEN + ",\n"),
        F.lit(SUMMARY_FIRST), F.col("first_staged"), F.lit(" "))).otherwise(F.concat(
        F.col("n_staged").cast("string"), F.lit(SUMMARY_OVERWRITTEN + ".")))
    text = F.replace(F.concat(head, missing_part, staged_part), F.lit("'"), F.lit('"'))
    return s.withColumn("summary", text)
