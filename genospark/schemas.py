"""Schemas and the fixed values the engine must share with the upload system.

The values under "FIXED VALUES" are part of the data contract (they decide
results) and are stated here as plain text, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the upload system's configuration)
# ---------------------------------------------------------------------------

# Allele pair (Allele1 - AB followed by Allele2 - AB) -> genotype digit.
DECODE_GENOTYPE = [("BB", "0"), ("AB", "1"), ("AA", "2"), ("--", "5")]

# Digit written for a position without a call.
MISSING_DIGIT = "5"

# Valid single allele letters.
VALID_ALLELES = ["A", "B", "-"]

# Field separators, tried in this order.
SEPARATORS = ["\t", ",", " \t", "-", ";"]

# Outcome code -> (bit_ok, bit_elaborato, errori_elab).
OUTCOMES = [
    ("c_A", 0, 1, "Incorrect file type"),
    ("c_B", 0, 0, "An error occurred. Please contact the system administrator."),
    ("m_A", 0, 1, "Error with the map"),
    ("m_B", 0, 1, "The uploaded file is invalid"),
    ("m_C", 0, 1, "Uploaded file contains more than one file"),
    ("m_D", 1, 1, "Map loaded (1)"),
    ("m_E", 1, 1, "Map loaded (2)"),
    ("m_F", 1, 1, "Map loaded (3)"),
    ("g_A", 0, 1, "Final report file with missing column errors"),
    ("g_B", 0, 1, "Final report file not found or incorrectly named"),
    ("g_C", 0, 1, "Final Report file with errors (1)"),
    ("g_D", 1, 1, "Genotype processing completed"),
    ("g_E", 0, 1, "Final Report file with errors (2)"),
    ("g_F", 0, 1, "Final report map not found or does not match"),
    ("g_G", 0, 1, "Final Report file with errors (2)"),
    ("g_H", 0, 1, "Uploaded file contains more than one file"),
    ("g_I", 1, 1, "Genotypes ready for loading"),
    ("g_K", 1, 1, "Genotypes ready for loading"),
    ("g_L", 0, 1, "Sample number does not correspond"),
    ("g_M", 0, 1, "Chip exists but separator different from those in the parameter list"),
    ("g_N", 0, 1, "Number or Names of SNPs different from an already loaded map. Correct or load new map"),
]

# Report column names, map column names, header markers.
COL_SNP = "SNP Name"
COL_SAMPLE = "Sample ID"
COL_ALLELE1 = "Allele1 - AB"
COL_ALLELE2 = "Allele2 - AB"
MAP_COL_INDEX = "Index"
MAP_COL_NAME = "Name"
REPORT_FIRST_LINE = "[Header]"
CONTENT_PREFIX = "Content"

# Prefix rewrite of queued file names, and output suffix of the panel file.
FILE_PREFIX_REWRITE = [("G_", "GEN_"), ("M_", "MAP_")]
PANEL_SUFFIX = "_ICAR"
PANEL_MAP = "554_ICAR"
MAX_SAMPLE_ID_LENGTH = 25
SUMMARY_LIST_SIZE = 10

# Texts of the reconciliation summary.
SUMMARY_READY = " genotypes ready to be uploaded.\n"
SUMMARY_NOT_IN_ARCHIVE = " samples not present in genomic archive\n"
SUMMARY_FIRST = "The first 10 are: "
SUMMARY_OVERWRITTEN = " samples with existing Genotype that will be overwritten"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

QUEUE_SCHEMA = T.StructType([
    T.StructField("nume_cari", T.LongType(), False),
    T.StructField("data_cari", T.TimestampNTZType(), True),
    T.StructField("user_cari", T.LongType(), True),
    T.StructField("tipo_cari", T.StringType(), True),
    T.StructField("nome_file", T.StringType(), True),
    T.StructField("bit_elaborato", T.IntegerType(), True),
])

LINES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("n_members", T.IntegerType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("line_no", T.LongType(), True),
    T.StructField("line", T.StringType(), True),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("map_name", T.StringType(), False),
    T.StructField("number_snp", T.IntegerType(), False),
    T.StructField("map_alias", T.StringType(), True),
])

SNP_MAPS_SCHEMA = T.StructType([
    T.StructField("map_name", T.StringType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("snp_name", T.StringType(), True),
])

STATUS_SCHEMA = T.StructType([
    T.StructField("nume_cari", T.StringType(), False),
    T.StructField("code", T.StringType(), True),
    T.StructField("bit_ok", T.IntegerType(), True),
    T.StructField("bit_elaborato", T.IntegerType(), True),
    T.StructField("errori_elab", T.StringType(), True),
])


def outcome_table(spark: SparkSession) -> DataFrame:
    """21-row outcome dimension; fixed size, safe to broadcast."""
    return spark.createDataFrame(
        OUTCOMES, "code string, bit_ok int, bit_elaborato int, errori_elab string")
