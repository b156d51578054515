"""One processing pass: pending uploads -> every output table.

``run_batch`` is the set-based counterpart of one poll of the upload
system: it decides every pending upload and writes the status log, the
staging rows (main and panel strings), the genotype and panel CSV files, the
QC tables, the newly registered maps and the alias updates.  Later passes
read the registered maps together with the catalogue.  ``process_queue_stream``
runs it for each micro-batch of a queue folder.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genospark.operators import queue
from genospark.plans import pipeline, sinks
from genospark.plans.commits import Published
from genospark.session import stored
from genospark.sources import tables
from genospark.sources.zipfiles import zip_lines
from genospark.streaming import queue_stream


@dataclass
class Layout:
    """Where inputs come from and outputs go (folders or JDBC option dicts for the tables)."""
    uploads: str            # folder with the zipped uploads
    catalog: str | dict
    snp_maps: str | dict
    archive: str | dict
    out: str                # folder for every output table
    named_files: bool = False  # export one file per upload under its own name, not a folder of parts
    atomic: bool = False    # publish a batch's tables by one commit (plans/commits.py) and read them through commits

    def path(self, name: str) -> str:
        return os.path.join(self.out, name)


def published(spark: SparkSession, layout: Layout) -> Published:
    return Published(spark, layout.path("published"))


def read_table(spark: SparkSession, layout: Layout, name: str, key: str | None = None) -> DataFrame | None:
    """An output table, or None before the first batch; with ``key``, an upload's rows are those of its last batch.
    Of an atomic layout only published batches are seen."""
    if layout.atomic:
        return published(spark, layout).read(name, key)
    try:
        return spark.read.parquet(layout.path(name))
    except AnalysisException:
        return None


def _registered(spark: SparkSession, layout: Layout, name: str, columns: list[str], batch: DataFrame) -> DataFrame | None:
    """Rows that earlier uploads registered; those of this batch's own uploads are written anew."""
    rows = read_table(spark, layout, name, "upload")
    if rows is None:  # nothing registered yet
        return None
    mine = batch.select(F.col("nume_cari").cast("long").alias("upload"))
    rows = rows.withColumn("upload", F.col("upload").cast("long")).join(mine, "upload", "left_anti")
    return rows.select(*[F.col(c).cast("string") if c in ("map_name", "snp_name", "map_alias") else F.col(c)
                         for c in columns])


def _export(run: pipeline.UploadRun, layout: Layout) -> None:
    write = ((sinks.write_genotype_files, sinks.write_panel_files) if layout.named_files
             else (sinks.write_genotype_csv, sinks.write_panel_csv))
    for write_one, name in zip(write, ("genotypes_csv", "panel_csv"), strict=True):
        write_one(run.staging, run.names, layout.path(name))


def run_batch(spark: SparkSession, queue_df: DataFrame, layout: Layout, batch: str | None = None) -> pipeline.UploadRun:
    """Decide the pending rows of ``queue_df``; running a named batch again replaces its rows."""
    pending = stored(queue.pending(queue_df), "batch")
    catalog = tables.read_catalog(spark, layout.catalog)
    snp_maps = tables.read_snp_maps(spark, layout.snp_maps)
    new = _registered(spark, layout, "new_catalog", catalog.columns, pending)
    if new is not None:
        catalog = stored(catalog.unionByName(new), "catalogue")
        snps = _registered(spark, layout, "new_snp_maps", snp_maps.columns, pending)
        # read before this batch replaces its own partitions
        snp_maps = snp_maps.unionByName(stored(snps, "registered-snps"))
    run = pipeline.process_uploads(
        pending, zip_lines(spark, layout.uploads, names=queue.file_names(pending).select("file_name")),
        catalog, snp_maps, tables.read_archive(spark, layout.archive))
    if layout.atomic:
        attempt = published(spark, layout).begin(batch or uuid.uuid4().hex)
        for name, rows in sinks.tables_of(run).items():
            attempt.write(name, rows)
        attempt.commit()
        # exports follow the commit; running the batch again writes the same files again
        _export(run, layout)
        return run
    sinks.write_staging(run.staging, layout.path("staging"))
    _export(run, layout)
    sinks.write_checks(run.qc, run.allele_errors, run.long_ids, layout.path("checks"))
    sinks.register_maps(run.catalog_rows, run.snp_rows, layout.path("new_catalog"), layout.path("new_snp_maps"))
    sinks.append_alias_updates(run.alias_updates, layout.path("alias_updates"))
    sinks.append_status(run.status, layout.path("status"), batch)  # last: the upload is decided
    return run


def _still_open(spark: SparkSession, layout: Layout, epoch_id: int, schema) -> DataFrame:
    """Queue rows that the last epoch before this one left pending."""
    last = _last_epoch(spark, layout, epoch_id)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(layout.path(f"open/epoch={last}"))


def _last_epoch(spark: SparkSession, layout: Layout, before: int) -> int | None:
    """The last epoch that wrote its open rows (there may be none of them)."""
    try:
        marks = spark.read.parquet(layout.path("open_epochs"))
    except AnalysisException:
        return None
    return marks.where(F.col("epoch") < before).agg(F.max("epoch")).first()[0]


def _keep_open(todo: DataFrame, run: pipeline.UploadRun, layout: Layout, epoch_id: int) -> None:
    """Keep the rows that are still pending for the next epoch."""
    left = run.status.where("bit_elaborato <> 1").selectExpr("CAST(nume_cari AS BIGINT) AS nume_cari")
    (todo.join(left, "nume_cari", "left_semi").select(*todo.columns).write.mode("overwrite")
     .parquet(layout.path(f"open/epoch={epoch_id}")))
    todo.sparkSession.range(1).write.mode("overwrite").parquet(layout.path(f"open_epochs/epoch={epoch_id}"))


def process_queue_stream(spark: SparkSession, queue_dir: str, schema, layout: Layout, checkpoint: str,
                         interval: str | None = None, archive_dir: str | None = None, stream: DataFrame | None = None):
    """Queue folder (or another ``stream`` of queue rows, e.g. ``queue_table``) as a stream; each micro-batch runs ``run_batch`` on its pending rows and on
    the rows that earlier micro-batches left pending (one row per upload, no final status yet).

    All writes are by upload or by micro-batch id, so a replayed micro-batch adds nothing.
    """
    def handle(batch: DataFrame, epoch_id: int) -> None:
        name = f"epoch-{epoch_id}"
        log = read_table(spark, layout, "status")
        if log is None:
            log = queue_stream.read_status(spark, layout.path("status"))
        if "batch" in log.columns:  # a replay decides its own uploads again
            log = log.where(~F.col("batch").isin(name, f"batch {name}"))
        done = log.where("bit_elaborato = 1").selectExpr("CAST(nume_cari AS BIGINT) AS nume_cari")
        rows = queue.pending(batch).unionByName(_still_open(spark, layout, epoch_id, schema))
        newest = Window.partitionBy("nume_cari").orderBy(F.col("data_cari").desc())
        todo = stored(rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")
                      .join(done, "nume_cari", "left_anti"), "todo")
        _keep_open(todo, run_batch(spark, todo, layout, name), layout, epoch_id)

    if stream is None:
        stream = queue_stream.queue_stream(spark, queue_dir, schema, archive_dir=archive_dir)
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if interval:
        return q.trigger(processingTime=interval).start()
    q = q.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def retry_open(spark: SparkSession, layout: Layout, schema, name: str) -> pipeline.UploadRun | None:
    """Try the uploads that are still open again, outside of a micro-batch (e.g. before a poll that
    brings no new rows); the ones that stay open are kept for the next time."""
    rows = stored(_still_open(spark, layout, 1 << 62, schema), "open")
    if rows.isEmpty():
        return None
    run = run_batch(spark, rows, layout, name)
    _keep_open(rows, run, layout, _last_epoch(spark, layout, 1 << 62))
    return run
