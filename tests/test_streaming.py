import os

from genospark.plans.fixtures import Fixtures
from genospark.sources.zipfiles import list_archives
from genospark.streaming import queue_stream


def test_stream_once_and_restart(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    jobs = fx.fx_jobs
    qdir, sdir, ck = (str(tmp_path / n) for n in ("queue", "status", "ck"))
    jobs.repartition(3, "nume_cari").write.parquet(qdir)
    files = list_archives(spark, str(tmp_path / "uploads"))
    queue_stream.run_queue(spark, qdir, jobs.schema, sdir, ck, files)
    first = spark.read.parquet(sdir).count()
    pending = jobs.where("coalesce(bit_elaborato, -1) = 0").count()
    assert first == pending
    queue_stream.run_queue(spark, qdir, jobs.schema, sdir, ck, files)  # restart: nothing new
    assert spark.read.parquet(sdir).count() == first
    # the uploads left pending (c_B) are the ones to try again (tests/test_pipeline.py does)
    retry = queue_stream.retry_set(jobs, spark.read.parquet(sdir))
    assert retry.count() == spark.read.parquet(sdir).where("code = 'c_B'").count()
    assert os.path.isdir(ck)


def test_processed_queue_files_are_archived(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    jobs = fx.fx_jobs
    qdir, sdir, ck, arch = (str(tmp_path / n) for n in ("queue", "status", "ck", "archive"))
    jobs.repartition(2).write.parquet(qdir)
    files = list_archives(spark, str(tmp_path / "uploads"))
    queue_stream.run_queue(spark, qdir, jobs.schema, sdir, ck, files, archive_dir=arch)
    assert spark.read.parquet(sdir).count() == jobs.where("coalesce(bit_elaborato, -1) = 0").count()
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".parquet")]
    assert archived  # processed queue files moved out of the source folder


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    jobs = Fixtures(spark, "/root/testdata/sf0.001").fx_jobs
    status = str(tmp_path / "status")
    handle = queue_stream.make_batch_handler(spark, status, list_archives(spark, str(tmp_path / "uploads")))
    for epoch in (0, 0, 1, 0):
        handle(jobs.where(f"nume_cari % 2 = {epoch}"), epoch)
    rows = spark.read.parquet(status)
    assert rows.count() == rows.select("nume_cari").distinct().count() == jobs.where("bit_elaborato = 0").count()
