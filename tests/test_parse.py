"""Parsing edge cases: separators, chip field, short lines, blank lines, missing header."""

from pyspark.sql import functions as F

from genospark.operators import outcomes, parse
from genospark.plans import pipeline

LINES = "nume_cari long, line_no long, line string"


def _lines(spark, files):
    rows = [(k, i, line) for k, text in files.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, LINES)


def test_layout_and_calls(spark):
    files = {
        1: "[Header]\nContent\t\tCHIP1\nSNP Name\tSample ID\tAllele1 - AB\tAllele2 - AB\ns1\tA\tA\tB\n\n",
        2: "[Header]\nContent; CHIP2\nSNP Name \tSample ID \tAllele1 - AB \tAllele2 - AB\ns1 \tA \tB \tB",
        3: "[Header]\nSNP Name,Sample ID,Allele1 - AB,Allele2 - AB\ns1,A,A\nContent,LATE",
        4: "[Header]\nContent,CHIP4\nno header here",
    }
    lines = _lines(spark, files)
    lay = {r["nume_cari"]: r for r in parse.report_layout(lines).collect()}
    assert (lay[1]["sep"], lay[1]["chip"]) == ("\t", "CHIP1")        # tab: field 2
    assert (lay[2]["sep"], lay[2]["chip"]) == (" \t", " CHIP2")      # ';' for the chip, space+tab header
    assert (lay[3]["sep"], lay[3]["chip"]) == (",", None)             # Content after the header: no chip
    assert lay[4]["sep"] is None and lay[4]["header_line_no"] is None
    calls = {(r["nume_cari"], r["line_no"]): (r["sample_id"], r["snp_name"], r["a1"], r["a2"])
             for r in parse.report_calls(lines, parse.report_layout(lines)).collect()}
    assert calls[(1, 3)] == ("A", "s1", "A", "B")
    assert (1, 4) not in calls and (1, 5) not in calls                 # trailing blank lines ignored
    assert calls[(2, 3)] == ("A", "s1", "B", "B")
    assert calls[(3, 2)] == ("A", "s1", "A", None)                     # short line: missing field
    assert calls[(3, 3)] == ("LATE", "Content", None, None)            # after the header every line is data


def test_outcomes_from_flags(spark):
    files = {
        10: "[Header]\nSNP Name\tSample ID\tAllele1 - AB\tAllele2 - AB\ns1\tA\tA",   # short line
        11: "[Header]\nnothing usable",                                           # no header
        12: "Index\tName\n1\tx",                                                  # not a report
    }
    cat = spark.createDataFrame([("1_a", 1, None)], "map_name string, number_snp int, map_alias string")
    maps = spark.createDataFrame([("1_a", 1, "s1")], "map_name string, id long, snp_name string")
    gb = pipeline.genotype_batch(_lines(spark, files), cat, maps)
    got = {r["nume_cari"]: r["code"] for r in pipeline.genotype_outcomes(gb).collect()}
    assert got == {10: "g_E", 11: "g_M", 12: "c_A"}


def test_type_code(spark):
    df = spark.createDataFrame([("M", "[Header]"), ("M", "Index"), ("G", "Index"), ("G", "[Header] x"), ("X", "?")],
                               "k string, f string")
    got = [r[0] for r in df.select(outcomes.type_code(F.col("k"), F.col("f"))).collect()]
    assert got == ["c_A", None, "c_A", None, None]
