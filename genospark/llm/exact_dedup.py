"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

Every batch is reduced to digests, the digests new to the index are found by a
sort-merge anti join against its buckets, and they are appended in the same
bucketing.  DataFrame operations only.

Defined cases: a null text counts as empty; repeated rows, also of one id, are
copies of each other and one of them stays; other columns of the batch are not read and may have any
name; an empty batch appends nothing and returns no rows.  A null id is never
kept before a row with an id.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.llm.skewed import join_groups
from genospark.session import scratch_path, stored


class DigestIndex:
    """Digests seen so far, each with the id of the row that stays and the batch that brought it.

    ``path`` is a shared folder and ``table`` its name in the catalog; a later
    session passes the same two and goes on with what is there.  The number of buckets is
    stored beside the index when it is made (by default the shuffle partitions of that session);
    an index is opened with its own number, whatever a later session's settings are, and asking for another one
    raises ``ValueError``.
    """

    def __init__(self, spark: SparkSession, path: str, table: str, buckets: int | None = None):
        self.spark, self.path, self.table = spark, path, table
        about = f"{path.rstrip('/')}-about"
        try:
            self.buckets = spark.read.parquet(about).first()["buckets"]
        except AnalysisException:  # a new index
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(about)
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE {table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, new: DataFrame, batch: str) -> None:
        (new.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
         .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.table))

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            row_col: str | None = None) -> DataFrame:
        """Dedup ``batch`` against the index and itself, and append what is new.

        Returns a row for each row of the batch: its id, ``keep_id`` (the row that
        stays: an earlier batch's, else the largest id of the copies),
        ``group_size`` (copies in the batch), ``kept`` and ``text_sha256``, and ``row_col``, a
        long that is unique to the row, if it is named.
        """
        row = F.col(row_col) if row_col else F.monotonically_increasing_id()
        digests = stored(batch.select(
            F.struct(F.col(id_col).alias("id"), row.alias("row")).alias("at"),
            F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest")), "digests")
        # partial aggregation folds the copies of a hot text before the shuffle
        groups = stored(digests.groupBy("digest").agg(
            F.max("at").alias("own"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
        new = groups.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
        name = uuid.uuid4().hex
        self.append(new.select("digest", F.col("own.id").alias("keep_id")), name)

        judged = groups.hint("merge").join(self.rows(), "digest")
        # ids may come again in a later batch, so a row stays by its batch and place, not by its id
        judged = judged.withColumn("mine", F.col("batch") == name).drop("batch")
        # rows of a hot text meet its group by broadcast, so no task gets them all
        both = join_groups(digests, judged, "digest", "group_size", digests.count())
        return both.select(
            F.col("at.id").alias(id_col), "keep_id", "group_size",
            (F.col("mine") & (F.col("at").eqNullSafe(F.col("own")))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), *([F.col("at.row").alias(row_col)] if row_col else []))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                row_col: str | None = None) -> DataFrame:
    """Decisions for ``docs`` against an index that starts empty."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digest-index")
    name = "digest_index_" + path[-32:]
    return DigestIndex(spark, path, name).add(docs, id_col, text_col, row_col)


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
