"""Upload-queue operators: pending rows, file names, type routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators.outcomes import type_code
from genospark.schemas import FILE_PREFIX_REWRITE, PANEL_SUFFIX

QUEUE_COLS = ["nume_cari", "data_cari", "user_cari", "tipo_cari", "nome_file", "bit_elaborato"]


def pending(queue: DataFrame) -> DataFrame:
    """Rows waiting for processing: flag 0; a null flag is not pending (a plain filter reaches the scan)."""
    return queue.where(F.col("bit_elaborato") == 0)


def in_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy("nume_cari", "data_cari")


def stored_name(nome_file):
    """``G_x`` -> ``GEN_x``, ``M_x`` -> ``MAP_x``."""
    out = nome_file
    for old, new in FILE_PREFIX_REWRITE:
        out = F.when(out.startswith(old), F.concat(F.lit(new), F.substring(out, len(old) + 1, 1 << 30))).otherwise(out)
    return out


def file_names(queue: DataFrame) -> DataFrame:
    name = stored_name(F.col("nome_file"))
    out = F.replace(name, F.lit(".zip"), F.lit(""))
    return queue.select("nume_cari", "nome_file", name.alias("file_name"),
                        name.endswith(".zip").alias("is_zip"),
                        out.alias("output_name"), F.concat(out, F.lit(PANEL_SUFFIX)).alias("panel_output_name"))


def route(queue: DataFrame, first_line_col: str = "first_line") -> DataFrame:
    """Map uploads go to the map branch, everything else to the genotype branch."""
    return queue.select("nume_cari", "tipo_cari",
                        F.when(F.col("tipo_cari") == "M", "map").otherwise("genotype").alias("route"),
                        type_code(F.col("tipo_cari"), F.col(first_line_col)).alias("type_code"))
