"""The queue table as a stream: restarts, late rows and rows set back to pending."""

import datetime as dt

import pyarrow.dataset as ds

from genospark.streaming import queue_table as Q
from genospark.streaming.queue_table import queue_table

SCHEMA = "nume_cari long, data_cari timestamp, tipo_cari string, nome_file string, bit_elaborato int"


def _add(spark, table, *rows):
    jobs = spark.createDataFrame([(k, dt.datetime(2024, 1, 1), "M", f"M_{k}.zip", flag) for k, flag in rows], SCHEMA)
    jobs.withColumn("other", jobs.nume_cari * 2).coalesce(1).write.mode("append").parquet(table)
    return jobs.schema


def _run(spark, table, schema, checkpoint):
    """Ids of each micro-batch until nothing is new."""
    seen = []
    q = (queue_table(spark, table, schema).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(lambda batch, epoch: seen.append(sorted(r.nume_cari for r in batch.collect()))).start())
    q.awaitTermination()
    return [ids for ids in seen if ids]


def test_restart_and_late_rows(spark, tmp_path):
    table, checkpoint = str(tmp_path / "queue"), str(tmp_path / "ck")
    schema = _add(spark, table, (5, 0), (7, 1), (9, None))
    assert _run(spark, table, schema, checkpoint) == [[5, 7, 9]]
    assert _run(spark, table, schema, checkpoint) == []  # a restart reads nothing again
    _add(spark, table, (3, 0), (4, 1))  # late, under smaller ids: the pending one is read, with the one still open
    assert _run(spark, table, schema, checkpoint) == [[3, 5]]
    _add(spark, table, (12, 0))
    assert _run(spark, table, schema, checkpoint) == [[3, 5, 12]]


def test_offsets_of_a_missing_and_an_empty_table(spark, tmp_path):
    table = str(tmp_path / "queue")
    reader = Q.QueueReader(f"file://{table}", _add(spark, str(tmp_path / "other"), (1, 0)))
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    _add(spark, table, (1, 0), (2, 0), (-3, 1))
    assert reader.latestOffset() == {"id": 2, "pending": 2}
    rows = [r for p in reader.partitions({"id": 1, "pending": 1}, {"id": 2, "pending": 2}) for b in reader.read(p)
            for r in b.column(0).to_pylist()]
    assert sorted(rows) == [1, 2] and "other" in ds.dataset(table).schema.names


def test_uploads_of_a_table_are_decided_once(spark, tmp_path):
    from genospark.plans.run import process_queue_stream
    from tests.helpers import map_file, write_zip
    from tests.test_pipeline import PANEL, _codes, _world
    d, layout = _world(spark, tmp_path, [("9_a", 9, None)], PANEL)
    table, checkpoint = str(tmp_path / "queue"), str(tmp_path / "ck")
    schema = _add(spark, table, (4, 0), (6, 1))
    write_zip(d, "MAP_2.zip", {"m.txt": map_file(["A", "B"])})

    def go():
        process_queue_stream(spark, table, schema, layout, checkpoint, stream=queue_table(spark, table, schema))
    go()
    assert _codes(spark, layout) == {4: "c_B"}  # its archive is not there yet
    _add(spark, table, (2, 0))
    write_zip(d, "MAP_4.zip", {"m.txt": map_file(["C", "D", "E"])})
    go()
    go()
    final = spark.read.parquet(layout.path("status")).where("bit_elaborato = 1").collect()
    assert sorted((int(r["nume_cari"]), r["code"]) for r in final) == [(2, "m_E"), (4, "m_E")]
