"""Readers for the system tables: a parquet folder or a JDBC table.

Each reader selects only the columns the engine uses, so parquet scans prune
columns and JDBC queries fetch only those; key filters are plain ``where``
clauses that reach the source (parquet row groups / partitions, JDBC WHERE).
Column names are normalised to lower case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, source: str | dict) -> DataFrame:
    """``source`` is a parquet path, or JDBC options (url, dbtable, user, password, ...)."""
    if isinstance(source, str):
        return spark.read.parquet(source)
    return spark.read.format("jdbc").options(**source).load()


def _lower(df: DataFrame, columns: list[str]) -> DataFrame:
    by_lower = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(by_lower[c]).alias(c) for c in columns])


def read_queue(spark: SparkSession, source: str | dict) -> DataFrame:
    """S1: the upload queue (six columns)."""
    return _lower(read_table(spark, source),
                  ["nume_cari", "data_cari", "user_cari", "tipo_cari", "nome_file", "bit_elaborato"])


def read_catalog(spark: SparkSession, source: str | dict) -> DataFrame:
    """S2: the map catalogue (one row per registered map)."""
    return _lower(read_table(spark, source), ["map_name", "number_snp", "map_alias"])


def read_snp_maps(spark: SparkSession, source: str | dict, map_names: list[str] | None = None) -> DataFrame:
    """S3/S4: SNP names of the maps; with a list, only those maps (partition pruning when the
    table is partitioned by map_name)."""
    df = _lower(read_table(spark, source), ["map_name", "id", "snp_name"])
    return df.where(F.col("map_name").isin(map_names)) if map_names else df


def read_archive(spark: SparkSession, source: str | dict,
                 column: str = "chr_codicecampionelab") -> DataFrame:
    """S5: the sample archive, one column."""
    return _lower(read_table(spark, source), [column])


def read_staging(spark: SparkSession, source: str | dict, uploads: DataFrame | None = None) -> DataFrame:
    """S6: staging rows; with ``uploads`` (one row per upload key), only those uploads.

    The keys' range is pushed to the source (a JDBC WHERE, parquet row groups); within it
    the semi join keeps the uploads themselves.
    """
    df = _lower(read_table(spark, source), ["nume_cari", "campione"])
    if uploads is None:
        return df
    low, high = uploads.agg(F.min("nume_cari"), F.max("nume_cari")).first()
    return (df.where(F.col("nume_cari").between(low, high))
            .join(uploads.select("nume_cari"), "nume_cari", "left_semi"))
