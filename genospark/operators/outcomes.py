"""Outcome codes per upload and their decoding into status columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.schemas import REPORT_FIRST_LINE, outcome_table

KEY = "nume_cari"


def type_code(kind, first_line):
    """c_A when a map upload starts like a report or a genotype upload does not."""
    is_report = first_line.startswith(REPORT_FIRST_LINE)
    return (F.when((kind == "M") & is_report, "c_A")
            .when((kind == "G") & ~F.coalesce(is_report, F.lit(False)), "c_A"))


def genotype_code() -> F.Column:
    """Rule order for a report upload (columns of ``genotype_flags``)."""
    return (F.when(F.col("type_code").isNotNull(), F.col("type_code"))
            .when(F.col("sep").isNull(), "g_M")
            .when(~F.col("has_alleles"), "g_A")
            .when(F.col("n_short") > 0, "g_E")
            .when(F.coalesce(F.col("n_samples"), F.lit(0)) == 0, "g_C")
            .when(~F.col("is_uniform"), "g_C")
            .when(F.col("map_name").isNull() | ~F.coalesce(F.col("consistent"), F.lit(False)), "g_N")
            .when(F.col("n_encoded") < F.col("n_samples"), "g_L")
            .when(F.col("alias_update"), "g_K")
            .otherwise("g_I"))


def decode(codes: DataFrame, code_col: str = "code") -> DataFrame:
    """Attach (bit_ok, bit_elaborato, errori_elab) from the 21-row outcome table (broadcast)."""
    table = F.broadcast(outcome_table(codes.sparkSession).withColumnRenamed("code", code_col))
    return codes.join(table, code_col, "left")


def status_rows(outcomes: DataFrame, summaries: DataFrame | None = None) -> DataFrame:
    """(nume_cari, code, bit_ok, bit_elaborato, errori_elab); successful genotype
    uploads carry their reconciliation summary as the message."""
    d = decode(outcomes)
    if summaries is not None:
        d = d.join(summaries.select(KEY, "summary"), KEY, "left")
        msg = F.when((F.col("bit_ok") == 1) & F.col("summary").isNotNull(), F.col("summary")).otherwise(F.col("errori_elab"))
    else:
        msg = F.col("errori_elab")
    return d.select(F.col(KEY).cast("string").alias(KEY), "code", "bit_ok", "bit_elaborato", msg.alias("errori_elab"))
