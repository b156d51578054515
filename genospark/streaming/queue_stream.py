"""The upload queue as a Structured Streaming source.

New queue rows arrive as files in a folder.  Each micro-batch (``foreachBatch``)
keeps the pending rows, drops uploads that already have a final status
(append-only status table, anti join), keeps one row per upload, decides the
outcome with the batch operators and appends status rows.  Uploads whose
outcome leaves them pending (bit_elaborato 0) are picked up again by a later
pass.  Progress lives in the checkpoint folder, so a restart re-reads nothing
that was committed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genospark.operators import outcomes, queue
from genospark.plans import sinks
from genospark.schemas import STATUS_SCHEMA
from genospark.session import stored


def queue_stream(spark: SparkSession, queue_dir: str, schema, files_per_trigger: int = 1,
                 archive_dir: str | None = None) -> DataFrame:
    """Queue rows as a file stream; with ``archive_dir`` processed files are moved there."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.parquet(queue_dir)


def read_status(spark: SparkSession, status_dir: str) -> DataFrame:
    """The status log, or an empty one before the first write."""
    try:
        return spark.read.parquet(status_dir)
    except AnalysisException:
        return spark.createDataFrame([], STATUS_SCHEMA.add("run_ts", "timestamp"))


def presence_outcome(batch: DataFrame, files: DataFrame) -> DataFrame:
    """Type check, then file presence: a missing map file leaves the upload pending (c_B),
    a missing report file fails it (g_B)."""
    names = queue.file_names(batch).select("nume_cari", "file_name")
    present = names.join(files.select("file_name").distinct().withColumn("found", F.lit(True)), "file_name", "left")
    typed = batch.select("nume_cari", "tipo_cari",
                         outcomes.type_code(F.col("tipo_cari"), F.col("first_line")).alias("type_code"))
    j = typed.join(present, "nume_cari")
    code = (F.when(F.col("type_code").isNotNull(), F.col("type_code"))
            .when(F.col("found").isNull() & (F.col("tipo_cari") == "M"), "c_B")
            .when(F.col("found").isNull(), "g_B"))
    return j.select("nume_cari", code.alias("code")).where(F.col("code").isNotNull())


def make_batch_handler(spark: SparkSession, status_dir: str, files: DataFrame):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        pend = queue.pending(batch)
        w = Window.partitionBy("nume_cari").orderBy(F.col("data_cari").desc())
        pend = pend.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        name = f"epoch-{epoch_id}"
        log = read_status(spark, status_dir)
        if "batch" in log.columns:  # a replay decides its own uploads again and replaces their rows
            log = log.where(F.col("batch") != name)
        done = log.where(F.col("bit_elaborato") == 1).select(F.col("nume_cari").cast("long").alias("nume_cari"))
        todo = stored(pend.join(done, "nume_cari", "left_anti"), "todo")
        sinks.append_status(outcomes.status_rows(presence_outcome(todo, files)), status_dir, name)
    return handle


def run_queue(spark: SparkSession, queue_dir: str, schema, status_dir: str, checkpoint: str,
              files: DataFrame, archive_dir: str | None = None, interval: str | None = None,
              stream: DataFrame | None = None):
    """Process the queue folder, or another ``stream`` of queue rows (e.g. ``queue_table``).

    Without ``interval``: everything available now, then stop.  With an
    interval (e.g. ``"30 seconds"``): poll like the upload system's loop and
    return the running query.
    """
    if stream is None:
        stream = queue_stream(spark, queue_dir, schema, archive_dir=archive_dir)
    q = (stream.writeStream.foreachBatch(make_batch_handler(spark, status_dir, files))
         .option("checkpointLocation", checkpoint))
    if interval:
        return q.trigger(processingTime=interval).start()
    q = q.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def retry_set(queue_df: DataFrame, status_log: DataFrame) -> DataFrame:
    """Pending uploads that still need work: no final status yet (latest bit_elaborato is not 1)."""
    latest = sinks.latest_status(status_log).where(F.col("bit_elaborato") == 1).select(
        F.col("nume_cari").cast("long").alias("nume_cari"))
    return queue.pending(queue_df).join(latest, "nume_cari", "left_anti")
