"""Batches are published as a whole or not at all."""

import datetime as dt
import os

import pytest

from genospark.plans import commits
from genospark.plans.run import Layout, read_table, run_batch
from helpers import map_file, report, write_zip
from test_pipeline import QUEUE, _report_rows


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def seen(published, key=None, table="t"):
    rows = published.read(table, key)
    return None if rows is None else sorted((r.k, r.v) for r in rows.collect())


def test_uncommitted_attempts_are_not_seen(spark, tmp_path):
    published = commits.Published(spark, str(tmp_path / "p"))
    assert seen(published) is None and published.current().collect() == []
    lost = published.begin("1")
    lost.write("t", frame(spark, (1, "lost")))
    assert seen(published) is None
    again = published.begin("1")
    again.write("t", frame(spark, (1, "a"), (2, "a")))
    assert seen(published) is None
    again.commit()
    assert seen(published) == [(1, "a"), (2, "a")] and seen(published, table="other") is None
    later = published.begin("2")
    later.write("t", frame(spark, (2, "b")))
    later.write("other", spark.createDataFrame([], "k int, v string"))
    assert seen(published, "k") == [(1, "a"), (2, "a")]
    later.commit()
    assert seen(published) == [(1, "a"), (2, "a"), (2, "b")] and seen(published, "k") == [(1, "a"), (2, "b")]
    assert seen(published, table="other") == []
    replay = published.begin("1")  # a batch that is run again is seen once
    replay.write("t", frame(spark, (1, "c")))
    replay.commit()
    assert seen(published) == [(1, "c"), (2, "b")]
    assert published.vacuum() == 2 and seen(published) == [(1, "c"), (2, "b")] and published.vacuum() == 0


def test_a_killed_run_shows_nothing_and_its_replay_all_once(spark, tmp_path, monkeypatch):
    d, three = str(tmp_path / "uploads"), ["S1", "S2", "S3"]
    os.makedirs(d)
    write_zip(d, "GEN_1.zip", {"r.txt": report(_report_rows(["A", "B"], three), chip="CHIPA")})
    write_zip(d, "MAP_2.zip", {"m.txt": map_file(["X1", "X2"])})
    t = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame([(1, t, 1, "G", "G_1.zip", 0), (2, t, 1, "M", "M_2.zip", 0), (3, t, 1, "G", "G_3.zip", 0)], QUEUE)
    for name, rows, schema in (
            ("catalog", [("3_a", 3, "CHIPA")], "map_name string, number_snp int, map_alias string"),
            ("maps", [("3_a", i + 1, n) for i, n in enumerate(three)] + [("554_ICAR", 1, "S2")], "map_name string, id long, snp_name string"),
            ("archive", [("A", )], "chr_codicecampionelab string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    layout = Layout(d, *(str(tmp_path / n) for n in ("catalog", "maps", "archive", "out")), atomic=True)
    tables = ("staging", "sample_qc", "new_catalog", "new_snp_maps", "status")
    whole = commits.Attempt.write

    def killed(self, table, rows):
        if table == "status":
            raise KeyboardInterrupt
        whole(self, table, rows)
    monkeypatch.setattr(commits.Attempt, "write", killed)
    with pytest.raises(KeyboardInterrupt):
        run_batch(spark, jobs, layout, "epoch-0")
    assert os.path.isdir(layout.path("published/new_catalog")) and all(read_table(spark, layout, n) is None for n in tables)
    monkeypatch.setattr(commits.Attempt, "write", whole)
    for _ in range(2):
        run_batch(spark, jobs, layout, "epoch-0")
        assert {int(r.nume_cari): r.code for r in read_table(spark, layout, "status").collect()} == {1: "g_I", 2: "m_E", 3: "g_B"}
        counts = [read_table(spark, layout, n).count() for n in tables]
        assert counts == [2, 2, 1, 2, 3]
    csv = spark.read.option("sep", ";").option("header", True).csv(layout.path("genotypes_csv"))
    assert csv.count() == 2
