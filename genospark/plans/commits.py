"""All-or-nothing publication of a batch's tables.

Every attempt at a batch writes its tables into folders of its own.  The batch is published by
one row in the table ``commits``: a single file, which the committer puts in place by one
rename.  Tables are read through that table only, so a reader sees all of a batch or
nothing, a run that was killed between two writes shows nothing, and a batch that is run again is
seen once, by its last commit.  What uncommitted attempts left stays unread until ``vacuum``.

One driver publishes at a time, as one queue has one stream.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "batch string, attempt string, seq long"


class Attempt:
    """One try at a batch: its tables are seen after ``commit``."""

    def __init__(self, published: Published, batch: str):
        self.published, self.batch, self.name = published, f"batch {batch}", f"a-{uuid.uuid4().hex}"

    def write(self, table: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.published.root}/{table}/batch={self.batch}/attempt={self.name}")

    def commit(self) -> None:
        done = self.published.commits()
        seq = (done.agg(F.max("seq")).first()[0] or 0) + 1
        row = self.published.spark.createDataFrame([(self.batch, self.name, seq)], COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.published.root}/commits")


class Published:
    """The published tables under a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def begin(self, batch: str) -> Attempt:
        return Attempt(self, batch)

    def commits(self) -> DataFrame:
        """(batch, attempt, seq), a row for each commit."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException:  # nothing published yet
            return self.spark.createDataFrame([], COMMITS)

    def current(self) -> DataFrame:
        """The last commit of each batch."""
        return self.commits().groupBy("batch").agg(F.max_by("attempt", "seq").alias("attempt"), F.max("seq").alias("seq"))

    def read(self, table: str, key: str | None = None) -> DataFrame | None:
        """The rows of all published batches, with ``batch`` and ``seq`` (the order of the commits); with ``key``, a key's
        rows come from the last batch that has any.  None before the first commit."""
        if self.commits().isEmpty():
            return None
        try:
            rows = self.spark.read.parquet(f"{self.root}/{table}")
        except AnalysisException:  # no batch has such a table
            return None
        rows = rows.join(self.current(), ["batch", "attempt"]).drop("attempt")
        if key:
            rows = rows.join(rows.groupBy(key).agg(F.max("seq").alias("seq")), [key, "seq"])
        return rows

    def vacuum(self) -> int:
        """Delete what attempts without a current commit have written; only while no batch is being written.
        Returns the number of folders."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/batch=*/attempt=*")) or []
        folders = self.spark.createDataFrame([(str(f.getPath()), f.getPath().getName()[len("attempt="):]) for f in found],
                                             "path string, attempt string")
        gone = [r["path"] for r in folders.join(self.current(), "attempt", "left_anti").collect()]  # one for each attempt's table
        for path in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        return len(gone)
