"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes the rows that its predecessor kept, read back from Parquet, and all
but the last return the columns of ``documents``.

A stage drops rows by a number of the row that no second scan can change (see
``numbered``).  The dropped numbers reach the texts as a stored table: a small one is
broadcast by its known size, so texts are shuffled only if many rows go.

Defined cases: null and empty texts pass the first stage by their weight of 0 or not at
all, one of them passes the second, and the rest as each operator says; rows are judged
one by one, also those that share an id or have none, and of near copies a row without
id stays only if none has one; an empty table gives an empty result of the last stage's columns; columns beside id and
text go through the first four stages untouched.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.llm.bm25_packing import pack
from genospark.llm.decontamination import decontaminate
from genospark.llm.exact_dedup import exact_dedup
from genospark.llm.importance_resampling import Resampling
from genospark.llm.ngram_jaccard import near_copies
from genospark.session import stored

_ROW = "__pipeline_row"
_FILE, _FILE_NUMBER = "__pipeline_file", "__pipeline_file_number"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a long in ``_ROW`` that is unique to the row and the same in every scan.

    A table of files is numbered by each row's file and place in it, however a scan is
    split.  Any other frame is stored with its numbers; one that has them stays.
    """
    if _ROW in docs.columns:
        return docs
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    at = docs.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias("__at"))
    # the driver lists the files of a table anyway
    paths = sorted(r[0] for r in at.select(_FILE).distinct().collect())
    # an Arrow table: a list would start a second kind of Python workers, which stay beside the others
    files = docs.sparkSession.createDataFrame(pa.table({
        _FILE: pa.array(paths, pa.string()), _FILE_NUMBER: pa.array(range(len(paths)), pa.int64())}))
    return at.join(F.broadcast(files), _FILE).select(
        *docs.columns, F.shiftleft(_FILE_NUMBER, 36).bitwiseOR(F.col("__at")).alias(_ROW))


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The ``numbered`` rows whose number is not in ``dropped``."""
    gone = stored(dropped.select(F.col(_ROW).alias("__gone")).distinct(), "dropped")
    return rows.join(gone, rows[_ROW] == gone["__gone"], "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return Resampling(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).kept_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    rows = numbered(docs)
    dropped = exact_dedup(rows, row_col=_ROW).where("NOT kept")
    return _without(rows, dropped).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id; texts without shingles have no copies."""
    rows = numbered(docs)
    found = near_copies(rows, id_col=_ROW).where("n_shingles > 0")
    found = stored(found.join(rows.select(_ROW, "doc_id"), _ROW).select(_ROW, "doc_id", "component_id"), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW))[_ROW].alias(_ROW)
    stay = found.groupBy("component_id").agg(first).select(_ROW)
    return _without(rows, found.join(stay, _ROW, "left_anti")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    rows = numbered(docs)
    found = decontaminate(rows.select(F.col(_ROW).alias("doc_id"), "text"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, found.where("contaminated").withColumnRenamed("doc_id", _ROW)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_copies", near),
          ("decontamination", decontamination), ("packing", packing)]

#: The first stage samples with hashed n-gram models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
