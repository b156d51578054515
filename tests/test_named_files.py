"""Output files under their own names: one file and one header each, whole or not there."""

import os
from types import SimpleNamespace

from pyspark.sql import Row

from genospark.plans import run as run_module
from genospark.plans import sinks
from genospark.plans.named_files import NamedFilesWriter, file_name, write_named_files
from genospark.plans.run import Layout

STAGED = ("nume_cari long, campione string, callrate_g double, mappa_usata_g string, genotipo string, "
          "genotipo_parentela string")


def _files(folder):
    out = {}
    for name in sorted(os.listdir(folder)):
        if os.path.isfile(os.path.join(folder, name)) and not name.startswith("."):
            with open(os.path.join(folder, name), encoding="utf-8", newline="") as f:
                out[name] = f.read()
    return out


def test_a_file_for_each_upload(spark, tmp_path):
    rows = [(1, "B", 0.5, "3_a", "150", "1"), (1, "A", 1.0, "3_a", "111", "1"), (2, "x;y", 1.0, None, "", None)]
    names = spark.createDataFrame([(1, "GEN_1"), (2, "a/b"), (3, "GEN_3")], "nume_cari long, output_name string")
    staged = spark.createDataFrame(rows, STAGED).repartition(3)
    sinks.write_genotype_files(staged, names, str(tmp_path / "csv"))
    sinks.write_panel_files(staged, names, str(tmp_path / "panel"))
    head = "Campione;CallRate;mappa_usata;Genotipo\n"
    both = {"GEN_1": head + "A;1.0;3_a;111\nB;0.5;3_a;150\n", "a%2Fb": head + '"x;y";1.0;;\n'}
    assert _files(tmp_path / "csv") == both
    assert _files(tmp_path / "panel") == {"GEN_1_ICAR": "Campione;Genotipo\nA;1\nB;1\n"}
    # written again: the upload's file is replaced, the other one stays
    sinks.write_genotype_files(staged.where("campione = 'A'"), names, str(tmp_path / "csv"))
    assert _files(tmp_path / "csv") == {**both, "GEN_1": head + "A;1.0;3_a;111\n"}
    assert os.listdir(tmp_path / "csv" / "_unfinished") == []


def test_a_large_file_over_many_partitions_has_one_header(spark, tmp_path):
    rows = spark.range(0, 30_000, 1, 16).selectExpr(
        "if(id % 3 = 0, concat('n', id % 50), 'hot') as name", "lpad(id, 6, '0') as line")
    write_named_files(rows, str(tmp_path / "out"), "name", ["line"])
    got = _files(tmp_path / "out")
    assert len(got) == 51
    lines = got["hot"].splitlines()
    assert lines[0] == "line" and len(lines) == 20_001 and lines[1:] == sorted(lines[1:])
    assert sum(len(t.splitlines()) - 1 for t in got.values()) == 30_000


def test_no_rows(spark, tmp_path):
    write_named_files(spark.createDataFrame([], "name string, line string"), str(tmp_path / "out"), "name", ["line"])
    assert not (tmp_path / "out").exists() or _files(tmp_path / "out") == {}


def test_a_repeated_task_and_a_lost_job(tmp_path):
    uri = f"file://{tmp_path}/out"
    rows = [Row("a", "1"), Row("a", "2"), Row("b", "3")]

    def broken():
        yield rows[0]
        raise OSError("executor lost")
    writer = NamedFilesWriter(uri, ";", ["x"])
    try:
        writer.write(broken())
    except OSError:
        pass
    writer.write(iter(rows))  # an attempt whose message never came
    message = writer.write(iter(rows))
    assert _files(tmp_path / "out") == {}  # nothing is seen before the commit
    writer.commit([message, None])
    assert _files(tmp_path / "out") == {"a": "x\n1\n2\n", "b": "x\n3\n"}
    lost = NamedFilesWriter(uri, ";", ["x"])
    lost.abort([lost.write(iter([Row("a", "9")])), None])
    assert _files(tmp_path / "out")["a"] == "x\n1\n2\n" and os.listdir(tmp_path / "out" / "_unfinished") == []


def test_names_that_are_no_file_names():
    names = [None, "", ".", "..", "_x", "a/b", "a%2Fb", "a\nb", "%", "%00", "Ünï 1.csv"]
    got = [file_name(n) for n in names]
    assert len(set(got)) == len(names) and got[-1] == names[-1]
    assert not any("/" in n or n[0] in "._" for n in got)


def test_the_layout_chooses_the_form_of_the_exports(spark, tmp_path):
    staged = spark.createDataFrame([(1, "A", 1.0, "3_a", "111", "1")], STAGED)
    names = spark.createDataFrame([(1, "GEN_1")], "nume_cari long, output_name string")
    for named in (True, False):
        layout = Layout("", "", "", "", str(tmp_path / str(named)), named_files=named)
        run_module._export(SimpleNamespace(staging=staged, names=names), layout)
    assert list(_files(tmp_path / "True" / "genotypes_csv")) == ["GEN_1"]
    assert list(_files(tmp_path / "True" / "panel_csv")) == ["GEN_1_ICAR"]
    assert os.path.isdir(tmp_path / "False" / "genotypes_csv" / "output_name=GEN_1")
