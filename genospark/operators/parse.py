"""Parsing of raw upload lines, set-based over all uploads at once.

A raw line table has one row per text line: (<key>, line_no, line).  Each
upload contributes one header row to a small per-upload layout table, which
is joined back to the lines so that the fields of every data line are cut with
built-in ``split``/``get``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.functions.columns import clean_line, first_separator, split_literal
from genospark.schemas import (COL_ALLELE1, COL_ALLELE2, COL_SAMPLE, COL_SNP, CONTENT_PREFIX,
                               MAP_COL_INDEX, MAP_COL_NAME, SEPARATORS)
from genospark.session import stored

TAB = "\t"


def _field_pos(fields, name):
    """0-based position of ``name`` in the header fields, null when absent."""
    p = F.array_position(fields, F.lit(name))
    return F.when(p > 0, (p - 1).cast("int"))


def report_layout(lines: DataFrame, key: str = "nume_cari") -> DataFrame:
    """One row per report upload: first line, chip, separator, column positions.

    sep: first candidate separator whose split of the ``SNP Name`` header holds
    both ``SNP Name`` and ``Sample ID``; null when none does (outcome g_M).
    chip: from the first ``Content`` line before the header, split by the first
    separator giving more than one field; field 2 for tab, else field 1.
    """
    # one scan: hash aggregates over line numbers (partial before the shuffle, so a large
    # upload moves one row per task), then the few marked lines by their numbers
    is_header, is_content = F.col("line").startswith(COL_SNP), F.col("line").startswith(CONTENT_PREFIX)
    marks = stored(lines.groupBy(key).agg(
        F.min("line_no").alias("first_line_no"), F.min(F.when(is_header, F.col("line_no"))).alias("header_line_no"),
        F.min(F.when(is_content, F.col("line_no"))).alias("content_line_no")), "marks")
    at = F.explode(F.array_distinct(F.array("first_line_no", "header_line_no", "content_line_no")))
    wanted = marks.select(key, at.alias("line_no")).where("line_no IS NOT NULL")
    texts = (lines.join(wanted, [key, "line_no"]).groupBy(key, "line_no").agg(F.min("line").alias("line"))
             .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("line_no", "line"))).alias("texts")))
    lay = marks.join(texts, key).select(
        key, "header_line_no", "content_line_no", F.col("texts")[F.col("first_line_no")].alias("first_line"),
        F.col("texts")[F.col("header_line_no")].alias("header"),
        F.col("texts")[F.col("content_line_no")].alias("content"))
    lay = lay.withColumn("content", F.when(
        F.col("header_line_no").isNull() | (F.col("content_line_no") < F.col("header_line_no")),
        clean_line(F.col("content"))))
    content_sep = F.get(F.filter(
        F.array(*[F.lit(s) for s in SEPARATORS]),
        lambda s: F.size(split_literal(F.col("content"), s)) > 1), 0)
    lay = lay.withColumn("content_sep", content_sep)
    chip_fields = split_literal(F.col("content"), F.col("content_sep"))
    lay = lay.withColumn("chip", F.when(
        F.col("content_sep").isNotNull(),
        F.get(chip_fields, F.when(F.col("content_sep") == TAB, 2).otherwise(1))))
    h = clean_line(F.col("header"))
    lay = lay.withColumn("sep", first_separator(h, [COL_SNP, COL_SAMPLE]))
    fields = split_literal(h, F.col("sep"))
    lay = (lay.withColumn("i_snp", _field_pos(fields, COL_SNP))
           .withColumn("i_sample", _field_pos(fields, COL_SAMPLE))
           .withColumn("i_a1", _field_pos(fields, COL_ALLELE1))
           .withColumn("i_a2", _field_pos(fields, COL_ALLELE2)))
    return lay.select(key, "first_line", "chip", "header_line_no", "sep",
                      "i_snp", "i_sample", "i_a1", "i_a2",
                      (F.col("i_a1").isNotNull() & F.col("i_a2").isNotNull()).alias("has_alleles"))


def report_calls(lines: DataFrame, layout: DataFrame, key: str = "nume_cari") -> DataFrame:
    """Data lines after the header, cut into (sample_id, snp_name, a1, a2).

    Only uploads with a separator and all four columns; blank lines are skipped.
    A short line yields nulls in the missing fields (the upload then fails).
    """
    usable = layout.where(F.col("sep").isNotNull() & F.col("has_alleles")).select(
        key, "header_line_no", "sep", "i_snp", "i_sample", "i_a1", "i_a2")
    # Pass a stored layout (one row per upload): the planner broadcasts it from its
    # file size, and beyond the threshold AQE splits the partitions of a large upload.
    body = lines.join(usable, key).where(F.col("line_no") > F.col("header_line_no"))
    text = clean_line(F.col("line"))
    body = body.where(text != "").withColumn("fields", split_literal(text, F.col("sep")))
    return body.select(
        key, "line_no",
        F.get("fields", F.col("i_sample")).alias("sample_id"),
        F.get("fields", F.col("i_snp")).alias("snp_name"),
        F.get("fields", F.col("i_a1")).alias("a1"),
        F.get("fields", F.col("i_a2")).alias("a2"))


def map_layout(lines: DataFrame, key: str = "upload_id") -> DataFrame:
    """One row per map upload: header line, separator and ``Name`` position.

    The header is the first line starting with ``Index``.  ``header_ok`` is
    false when it lacks ``Name`` or no separator splits it into fields holding
    both ``Index`` and ``Name`` (outcome m_B).
    """
    header = (lines.where(F.col("line").startswith(MAP_COL_INDEX)).groupBy(key)
              .agg(F.min_by("line", "line_no").alias("header"), F.min("line_no").alias("header_line_no")))
    uploads = lines.select(key).distinct()
    lay = uploads.join(header, key, "left")
    h = clean_line(F.col("header"))
    lay = lay.withColumn("sep", F.when(F.col("header").contains(MAP_COL_NAME),
                                       first_separator(h, [MAP_COL_INDEX, MAP_COL_NAME])))
    lay = lay.withColumn("i_name", _field_pos(split_literal(h, F.col("sep")), MAP_COL_NAME))
    return lay.select(key, "header_line_no", "sep", "i_name",
                      F.col("i_name").isNotNull().alias("header_ok"))


def map_records(lines: DataFrame, layout: DataFrame, key: str = "upload_id") -> DataFrame:
    """SNP names of map uploads with a valid header: the ``Name`` field of every later non-blank line."""
    ok = layout.where("header_ok").select(key, "header_line_no", "sep", "i_name")
    body = lines.join(ok, key).where(F.col("line_no") > F.col("header_line_no"))
    text = clean_line(F.col("line"))
    return body.where(text != "").select(
        key, "line_no", F.get(split_literal(text, F.col("sep")), F.col("i_name")).alias("snp_name"))
