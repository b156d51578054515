"""Spark session helpers.

The library never picks storage locations on its own: lineage cuts use the
shared folder named by ``spark.checkpoint.dir``.  Only ``local_session`` (used by
tests, bench and the driver smoke check) and ``local_checkpoint_dir`` (the entry) fill
that setting in when it is unset, on one machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # zipped uploads arrive as one binary row each: keep Arrow batches small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


#: Pages and row groups of intermediate tables are bounded by bytes from the first row on.  Parquet's writer else
#: looks after 100 rows; rows of a megabyte then make one page of a whole file, which the codec copies at once
#: outside the heap, in the writing and in the reading task.
PARQUET_BOUNDS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1,
                  "parquet.page.size.row.check.min": 1}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "genospark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # small test data: keep CPU-heavy stages spread over the local cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_checkpoint_dir(spark)
    return spark


def local_checkpoint_dir(spark: SparkSession) -> None:
    """For harnesses (entry, bench, tests) on one machine: a fresh folder where the setting is unset."""
    if spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="genospark-ckpt-"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``), which must be set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
    return path


#: Spark then deletes an execution's shuffle files when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is executed inside leaves no shuffle files: for results that are stored or collected, which nobody shuffles again."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage (a lost executor recomputes nothing before this point: the
    rows live in the shared folder, unlike ``localCheckpoint``), lets later
    scans prune columns and push filters, and gives the planner real sizes.
    Used where one intermediate is read by several branches.  The shuffle files behind it are deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_deleted(spark):
        df.write.mode("overwrite").options(**PARQUET_BOUNDS).parquet(path, compression=compression)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one intermediate table.

    The application id and a uuid make the name unique among all drivers that
    share the folder, so no run can overwrite another one's rows.
    """
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete every intermediate table this application wrote.

    Only for callers that have written their final outputs: frames read from
    ``stored()`` tables are unusable afterwards.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _application_dir(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/genospark/{spark.sparkContext.applicationId}"
