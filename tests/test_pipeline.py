"""End to end: queue rows + zipped uploads -> one outcome per pending upload."""

import datetime as dt

from pyspark.sql import functions as F

from genospark.plans import pipeline
from genospark.sources.zipfiles import zip_lines

from helpers import map_file, report, write_zip

QUEUE = "nume_cari long, data_cari timestamp, user_cari long, tipo_cari string, nome_file string, bit_elaborato int"


def _report_rows(samples, snps, alleles=("A", "B")):
    return [(s, smp, alleles[0], alleles[1]) for smp in samples for s in snps]


def test_outcomes(spark, tmp_path):
    d = str(tmp_path / "uploads")
    import os
    os.makedirs(d)
    three = ["S1", "S2", "S3"]
    write_zip(d, "GEN_1.zip", {"r.txt": report(_report_rows(["A", " B"], three), chip="CHIPA")})
    write_zip(d, "GEN_2.zip", {"r.txt": report(_report_rows(["C"], three), sep=",", chip=None)})
    write_zip(d, "GEN_3.zip", {"r.txt": report(_report_rows(["D"], three),
                                               header=("SNP Name", "Sample ID", "Allele1 - Top", "Allele2 - AB"))})
    write_zip(d, "GEN_4.zip", {"r.txt": report(_report_rows(["E"], three), sep="|", chip=None)})
    write_zip(d, "GEN_5.zip", {"r.txt": report(_report_rows(["F"], three) + [("S1", "G", "A", "A")])})
    write_zip(d, "GEN_6.zip", {"a.txt": "x", "b.txt": "y"})
    write_zip(d, "MAP_8.zip", {"m.txt": "[Header]\nIndex\tName\n1\tX\n"})
    write_zip(d, "MAP_9.zip", {"m.txt": map_file(["X1", "X2"])})
    write_zip(d, "MAP_10.zip", {"m.txt": map_file(three)})
    write_zip(d, "MAP_11.zip", {"m.txt": map_file(["S1", "S2", "S9"], sep=";")})
    write_zip(d, "MAP_12.zip", {"m.txt": map_file(["S1", "S1"])})
    write_zip(d, "MAP_13.zip", {"m.txt": map_file(["S1"], header=("Index", "SNP", "Chr"))})
    # resolved by size: before MAP_11 registers a second map of size 3, and after it
    write_zip(d, "GEN_0.zip", {"r.txt": report(_report_rows(["H"], three), chip="CHIPZ")})
    write_zip(d, "GEN_14.zip", {"r.txt": report(_report_rows(["H"], three), chip="CHIPZ")})
    write_zip(d, "GEN_15.zip", {"r.txt": report(_report_rows(["I"], three))})
    t = dt.datetime(2024, 1, 1)
    jobs = [(k, t, 1, "M" if k in (8, 9, 10, 11, 12, 13) else "G",
             f"{'M' if k in (8, 9, 10, 11, 12, 13) else 'G'}_{k}.zip", 1 if k == 15 else 0)
            for k in range(16)]
    queue = spark.createDataFrame(jobs, QUEUE)
    catalog = spark.createDataFrame([("3_a", 3, "CHIPA")], "map_name string, number_snp int, map_alias string")
    snp_maps = spark.createDataFrame(
        [("3_a", i + 1, n) for i, n in enumerate(three)] + [("554_ICAR", 1, "S1"), ("554_ICAR", 2, "S3")],
        "map_name string, id long, snp_name string")
    archive = spark.createDataFrame([("  A ",), (None,), ("C",)], "chr_codicecampionelab string")
    run = pipeline.process_uploads(queue, zip_lines(spark, d), catalog, snp_maps, archive)
    codes = {int(r["nume_cari"]): r["code"] for r in run.status.collect()}
    assert codes == {0: "g_K", 1: "g_I", 2: "g_I", 3: "g_A", 4: "g_M", 5: "g_C", 6: "g_H", 7: "g_B",
                     8: "c_A", 9: "m_E", 10: "m_D", 11: "m_F", 12: "m_A", 13: "m_B", 14: "g_N"}
    staged = {(r["nume_cari"], r["campione"]): r for r in run.staging.collect()}
    assert staged[(1, "A")]["genotipo"] == "111" and staged[(1, "A")]["genotipo_parentela"] == "11"
    assert staged[(1, " B")]["callrate_g"] == 1.0
    assert staged[(0, "H")]["mappa_usata_g"] == "3_a"
    assert {r["map_name"] for r in run.catalog_rows.collect()} == {"2_a", "3_b"}
    assert sorted((r["map_name"], r["id"], r["snp_name"]) for r in run.snp_rows.where("map_name = '2_a'").collect()) == [
        ("2_a", 1, "X1"), ("2_a", 2, "X2")]
    upd = run.alias_updates.collect()
    assert [(r["nume_cari"], r["map_name"], r["map_alias"]) for r in upd] == [(0, "3_a", "CHIPZ")]
    msg = {int(r["nume_cari"]): r["errori_elab"] for r in run.status.collect()}
    assert msg[1].startswith("2 genotypes ready to be uploaded.\n1 samples not present in genomic archive\n"
                             "The first 10 are:  B\n2 samples with existing Genotype")
    assert msg[7] == "Final report file not found or incorrectly named"
    names = {r["nume_cari"]: r["output_name"] for r in run.names.collect()}
    assert names[1] == "GEN_1"


def test_sinks_roundtrip(spark, tmp_path):
    from genospark.plans import sinks
    rows = spark.createDataFrame([(1, "A", 1.0, "3_a", "111", "11")],
                                 "nume_cari long, campione string, callrate_g double, mappa_usata_g string, "
                                 "genotipo string, genotipo_parentela string")
    names = spark.createDataFrame([(1, "GEN_1")], "nume_cari long, output_name string")
    sinks.write_genotype_csv(rows, names, str(tmp_path / "csv"))
    sinks.write_panel_csv(rows, names, str(tmp_path / "panel"))
    text = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "csv"))
    assert [tuple(r) for r in text.select("Campione", "CallRate", "mappa_usata", "Genotipo").collect()] == [
        ("A", "1.0", "3_a", "111")]
    panel = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "panel"))
    assert panel.select("output_name").first()[0] == "GEN_1_ICAR"
    sinks.write_staging(rows.unionByName(rows.withColumn("nume_cari", F.lit(2).cast("long"))), str(tmp_path / "stg"))
    sinks.write_staging(rows.withColumn("genotipo", F.lit("000")), str(tmp_path / "stg"))  # rerun of upload 1 only
    got = sorted((r["nume_cari"], r["genotipo"]) for r in spark.read.parquet(str(tmp_path / "stg")).collect())
    assert got == [(1, "000"), (2, "111")]  # upload 2's partition is untouched


def test_stream_runs_full_batches(spark, tmp_path):
    """Queue rows arrive as files; each micro-batch decides its uploads and writes every output."""
    import os
    from genospark.plans.run import Layout, process_queue_stream
    d = str(tmp_path / "uploads")
    os.makedirs(d)
    three = ["S1", "S2", "S3"]
    write_zip(d, "GEN_1.zip", {"r.txt": report(_report_rows(["A", "B"], three), chip="CHIPA")})
    write_zip(d, "MAP_2.zip", {"m.txt": map_file(["X1", "X2"])})
    t = dt.datetime(2024, 1, 1)
    queue = spark.createDataFrame([(1, t, 1, "G", "G_1.zip", 0), (2, t, 1, "M", "M_2.zip", 0),
                                   (3, t, 1, "G", "G_3.zip", 0)], QUEUE)
    qdir = str(tmp_path / "queue")
    queue.repartition(3, "nume_cari").write.parquet(qdir)
    spark.createDataFrame([("3_a", 3, "CHIPA")], "map_name string, number_snp int, map_alias string") \
        .write.parquet(str(tmp_path / "catalog"))
    spark.createDataFrame([("3_a", i + 1, n) for i, n in enumerate(three)] + [("554_ICAR", 1, "S2")],
                          "map_name string, id long, snp_name string").write.parquet(str(tmp_path / "maps"))
    spark.createDataFrame([("A",)], "chr_codicecampionelab string").write.parquet(str(tmp_path / "archive"))
    layout = Layout(d, str(tmp_path / "catalog"), str(tmp_path / "maps"), str(tmp_path / "archive"),
                    str(tmp_path / "out"))
    process_queue_stream(spark, qdir, queue.schema, layout, str(tmp_path / "ck"))
    status = {int(r["nume_cari"]): r["code"] for r in spark.read.parquet(layout.path("status")).collect()}
    assert status == {1: "g_I", 2: "m_E", 3: "g_B"}
    staged = spark.read.parquet(layout.path("staging")).collect()
    assert sorted((r["campione"], r["genotipo"], r["genotipo_parentela"]) for r in staged) == [
        ("A", "111", "1"), ("B", "111", "1")]
    assert [r["map_name"] for r in spark.read.parquet(layout.path("new_catalog")).collect()] == ["2_a"]
    csv = spark.read.option("sep", ";").option("header", True).csv(layout.path("genotypes_csv"))
    assert csv.count() == 2


def _world(spark, tmp_path, catalog, snps):
    """Folders for one run: uploads, catalogue, maps, archive, outputs."""
    import os
    from genospark.plans.run import Layout
    d = str(tmp_path / "uploads")
    os.makedirs(d)
    spark.createDataFrame(catalog, "map_name string, number_snp int, map_alias string").write.parquet(
        str(tmp_path / "catalog"))
    spark.createDataFrame(snps, "map_name string, id long, snp_name string").write.parquet(str(tmp_path / "maps"))
    spark.createDataFrame([("A",)], "chr_codicecampionelab string").write.parquet(str(tmp_path / "archive"))
    return d, Layout(d, str(tmp_path / "catalog"), str(tmp_path / "maps"), str(tmp_path / "archive"),
                     str(tmp_path / "out"))


def _queue(spark, *rows):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, t, 1, kind, f"{kind}_{k}.zip", 0) for k, kind in rows], QUEUE)


def _codes(spark, layout):
    return {int(r["nume_cari"]): r["code"] for r in spark.read.parquet(layout.path("status")).collect()}


PANEL = [("554_ICAR", 1, "S1")]


def test_empty_panel_map_leaves_its_uploads_pending(spark, tmp_path):
    from genospark.plans.run import run_batch
    d, layout = _world(spark, tmp_path, [("1_a", 1, "CHIPA")], [("1_a", 1, "S1")])
    write_zip(d, "GEN_1.zip", {"r.txt": report(_report_rows(["A"], ["S1"]), chip="CHIPA")})
    write_zip(d, "MAP_2.zip", {"m.txt": map_file(["X", "Y"])})
    write_zip(d, "GEN_3.zip", {"r.txt": report(_report_rows(["A"], ["NOPE"]), chip="CHIPA")})
    run_batch(spark, _queue(spark, (1, "G"), (2, "M"), (3, "G")), layout)
    assert _codes(spark, layout) == {1: "c_B", 2: "m_E", 3: "g_N"}
    flags = {int(r["nume_cari"]): r["bit_elaborato"] for r in spark.read.parquet(layout.path("status")).collect()}
    assert flags == {1: 0, 2: 1, 3: 1}


def _map_report_map(d):
    write_zip(d, "MAP_1.zip", {"m.txt": map_file(["P", "Q", "R"])})
    write_zip(d, "GEN_2.zip", {"r.txt": report(_report_rows(["A", "B"], ["P", "Q", "R"]), chip=None)})
    write_zip(d, "MAP_3.zip", {"m.txt": map_file(["R", "Q", "P"])})


def _one_registration(spark, layout):
    rows = spark.read.parquet(layout.path("new_catalog")).collect()
    assert [(r["map_name"], r["number_snp"], int(r["upload"])) for r in rows] == [("3_a", 3, 1)]
    snps = spark.read.parquet(layout.path("new_snp_maps")).orderBy("id").collect()
    assert [(r["id"], r["snp_name"]) for r in snps] == [(1, "P"), (2, "Q"), (3, "R")]


def test_a_registered_map_is_seen_by_later_batches(spark, tmp_path):
    from genospark.plans.run import run_batch
    d, layout = _world(spark, tmp_path, [("9_a", 9, None)], PANEL)
    _map_report_map(d)
    for k, kind in ((1, "M"), (2, "G"), (3, "M"), (1, "M")):  # the first one again: nothing new
        run_batch(spark, _queue(spark, (k, kind)), layout, f"b{k}")
        assert _codes(spark, layout)[k] == {1: "m_E", 2: "g_I", 3: "m_D"}[k]
    _one_registration(spark, layout)
    assert spark.read.parquet(layout.path("status")).count() == 3
    staged = spark.read.parquet(layout.path("staging")).collect()
    assert {(r["campione"], r["genotipo"], r["mappa_usata_g"], r["file_name"]) for r in staged} == {
        ("A", "111", "3_a", "GEN_2.zip"), ("B", "111", "3_a", "GEN_2.zip")}
    qc = spark.read.parquet(layout.path("checks/sample_qc")).collect()
    assert {(r["campione"], r["n_missing"], r["n_not_in_map"], r["call_rate"]) for r in qc} == {
        ("A", 0, 0, 1.0), ("B", 0, 0, 1.0)}
    assert spark.read.parquet(layout.path("checks/allele_errors")).first()["n_bad_a1"] == 0


def test_a_map_is_seen_by_later_uploads_of_its_batch(spark, tmp_path):
    from genospark.plans.run import run_batch
    d, layout = _world(spark, tmp_path, [("9_a", 9, None)], PANEL)
    _map_report_map(d)
    write_zip(d, "GEN_0.zip", {"r.txt": report(_report_rows(["A"], ["P", "Q", "R"]), chip=None)})
    run_batch(spark, _queue(spark, (0, "G"), (1, "M"), (2, "G"), (3, "M")), layout)
    assert _codes(spark, layout) == {0: "g_N", 1: "m_E", 2: "g_I", 3: "m_D"}
    _one_registration(spark, layout)


def test_damaged_archives_keep_no_line(spark, tmp_path):
    import zipfile
    from genospark.plans.run import run_batch
    d, layout = _world(spark, tmp_path, [("3_a", 3, "CHIPA")], [("3_a", i, f"S{i}") for i in (1, 2, 3)] + PANEL)
    rows = [(f"S{1 + k % 3}", f"smp{k // 3}", "A", "B") for k in range(60_000)]
    write_zip(d, "GEN_1.zip", {"r.txt": report(rows, chip="CHIPA")})
    for k in (2, 3, 4):
        with zipfile.ZipFile(f"{d}/GEN_{k}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("r.txt", report(rows, chip="CHIPA"))
    raw = bytearray(open(f"{d}/GEN_2.zip", "rb").read())
    at = raw.rfind(b"PK\x01\x02")
    raw[at + 16:at + 20] = b"abcd"  # the directory's checksum
    open(f"{d}/GEN_2.zip", "wb").write(raw)
    raw = bytearray(open(f"{d}/GEN_3.zip", "rb").read())
    raw[len(raw) // 2:len(raw) // 2 + 400] = b"\xff" * 400  # the stream
    open(f"{d}/GEN_3.zip", "wb").write(raw)
    raw = bytearray(open(f"{d}/GEN_4.zip", "rb").read())
    raw[6] |= 1  # marked as encrypted
    raw[raw.rfind(b"PK\x01\x02") + 8] |= 1
    open(f"{d}/GEN_4.zip", "wb").write(raw)
    run_batch(spark, _queue(spark, (1, "G"), (2, "G"), (3, "G"), (4, "G")), layout)
    assert _codes(spark, layout) == {1: "g_I", 2: "c_B", 3: "c_B", 4: "c_B"}
    staged = spark.read.parquet(layout.path("staging"))
    assert [r["nume_cari"] for r in staged.select("nume_cari").distinct().collect()] == [1] and staged.count() == 20_000


def test_open_uploads_are_tried_again(spark, tmp_path):
    from genospark.plans.run import process_queue_stream, retry_open
    d, layout = _world(spark, tmp_path, [("3_a", 3, None)], [("3_a", i, f"S{i}") for i in (1, 2, 3)] + PANEL)
    qdir = str(tmp_path / "queue")
    first = _queue(spark, (1, "M"), (2, "M"))
    first.coalesce(1).write.parquet(qdir)
    process_queue_stream(spark, qdir, first.schema, layout, str(tmp_path / "ck"))
    assert _codes(spark, layout) == {1: "c_B", 2: "c_B"}
    write_zip(d, "MAP_1.zip", {"m.txt": map_file(["X1", "X2"])})  # the archive comes late
    _queue(spark, (3, "G")).coalesce(1).write.mode("append").parquet(qdir)
    process_queue_stream(spark, qdir, first.schema, layout, str(tmp_path / "ck"))
    latest = {(r["batch"], int(r["nume_cari"])): r["code"] for r in spark.read.parquet(layout.path("status")).collect()}
    assert latest == {("epoch-0", 1): "c_B", ("epoch-0", 2): "c_B", ("epoch-1", 1): "m_E", ("epoch-1", 2): "c_B",
                      ("epoch-1", 3): "g_B"}
    write_zip(d, "MAP_2.zip", {"m.txt": map_file(["Y1", "Y2"])})
    assert retry_open(spark, layout, first.schema, "again") is not None
    assert retry_open(spark, layout, first.schema, "again-2") is None
    final = spark.read.parquet(layout.path("status")).where("bit_elaborato = 1").collect()
    assert {(int(r["nume_cari"]), r["code"]) for r in final} == {(1, "m_E"), (2, "m_F"), (3, "g_B")}


def test_one_archive_is_read_of_several_with_one_name(spark, tmp_path):
    """Of archives with one name in several folders the first by path is read and recorded."""
    import os
    for folder, snps in (("b", ["T1", "T1"]), ("a", ["S1", "S2"]), ("c", ["U1"])):
        os.makedirs(tmp_path / "up" / folder)
        write_zip(str(tmp_path / "up" / folder), "MAP_x.zip", {"m.txt": map_file(snps)})
    jobs = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1, "M", "MAP_x.zip", 0)], QUEUE)
    catalog = spark.createDataFrame([], "map_name string, number_snp int, map_alias string")
    snp_maps = spark.createDataFrame([], "map_name string, id long, snp_name string")
    archive = spark.createDataFrame([], "chr_codicecampionelab string")
    from genospark.operators import queue
    names = queue.file_names(queue.pending(jobs))
    stored_name = names.first()["file_name"]
    if stored_name != "MAP_x.zip":
        for folder in "abc":
            os.rename(tmp_path / "up" / folder / "MAP_x.zip", tmp_path / "up" / folder / stored_name)
    run = pipeline.process_uploads(jobs, zip_lines(spark, str(tmp_path / "up"), names=names.select("file_name")),
                                   catalog, snp_maps, archive)
    assert [(int(r["nume_cari"]), r["code"]) for r in run.status.collect()] == [(1, "m_E")]
    assert [r["snp_name"] for r in run.snp_rows.orderBy("id").collect()] == ["S1", "S2"]
    path, = [r["path"] for r in run.archives.collect()]
    assert path.endswith(f"/up/a/{stored_name}")
