"""Genotype encoding: golden cases and invariants (q28's oracle is the brute force)."""

import random

from pyspark.sql import functions as F

from genospark.operators import encode
from genospark.plans.fixtures import Fixtures

SCHEMA = "nume_cari int, line_no long, sample_id string, snp_name string, a1 string, a2 string"
MAP_SCHEMA = "map_name string, id long, snp_name string"


def _encode(spark, calls, snps):
    c = spark.createDataFrame(calls, SCHEMA).withColumn("map_name", F.lit("M"))
    m = spark.createDataFrame([("M", i, n) for i, n in snps], MAP_SCHEMA)
    rows = encode.staging_rows(c, m).collect()
    return {r["campione"]: (r["genotipo"], r["callrate_g"]) for r in rows}


def test_golden_rules(spark):
    snps = [(1, "s1"), (2, "S2"), (3, "S3"), (4, "s1"), (5, "S5")]  # 's1' twice: first id kept
    calls = [
        (1, 1, "A", "S1", "A", "A"),   # upper-case match, AA -> 2
        (1, 2, "A", "S2", "A", "B"),   # AB -> 1
        (1, 3, "A", "S2", "B", "A"),   # BA undecodable: S2 keeps 1
        (1, 4, "A", "S3", "B", "B"),   # BB -> 0
        (1, 5, "A", "S3", "-", "-"),   # '--' -> 5 overwrites the 0
        (1, 6, "A", "NOPE", "A", "A"),  # not in the map
        (1, 7, "B", "S5", "A", "X"),   # invalid allele: nothing placed
    ]
    out = _encode(spark, calls, snps)
    assert out["A"] == ("2155", 0.5)     # 4 positions (duplicate upper name dropped)
    assert out["B"] == ("5555", 0.0)     # seen in the file, no usable call


def test_invariants_and_row_order(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in fx.fx_calls.collect()]
    snps = fx.fx_snp_map.where("map_name = 'MAIN_a'")
    n = encode.map_positions(snps).count()
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    a = encode.staging_rows(spark.createDataFrame(rows, fx.fx_calls.schema).withColumn("map_name", F.lit("MAIN_a")), snps)
    b = encode.staging_rows(spark.createDataFrame(shuffled, fx.fx_calls.schema).repartition(7)
                            .withColumn("map_name", F.lit("MAIN_a")), snps)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb
    for r in ra:
        g = r[4]
        assert len(g) == n
        assert set(g) <= set("0125")
        assert abs(r[2] - round(sum(c != "5" for c in g) / n, 4)) < 1e-9


def test_panel_join_holds_calls_not_strings(spark):
    """A few calls on a map of 5000 SNPs: what is joined has no string of the map's length; a dense sample has one."""
    snps = [("M", k, f"S{k}") for k in range(5000)]
    panel = [("P", k, f"S{k}") for k in range(4)]
    calls = [(1, 1, "A", "S7", "A", "A"), (1, 2, "A", "S2", "A", "B"), (1, 3, "B", "NOPE", "A", "A"), (2, 1, "A", "S0", "B", "B")]
    calls += [(3, k, "D", f"S{k}", "A", "A") for k in range(200)]
    c = spark.createDataFrame(calls, SCHEMA)
    maps = spark.createDataFrame(snps + panel, MAP_SCHEMA)
    main = encode.sample_calls(c.withColumn("map_name", F.lit("M")), maps.where("map_name = 'M'"))
    own = {(r.nume_cari, r.sample_id): r for r in main.collect()}
    assert own[1, "A"].genotype is None and len(own[1, "A"].calls) == 2 and own[3, "D"].calls is None
    part = encode.sample_calls(c.where("nume_cari <> 2").withColumn("map_name", F.lit("P")), maps.where("map_name = 'P'"))
    got = {(r.nume_cari, r.campione): (r.genotipo, r.genotipo_parentela) for r in encode.with_panel(main, part).collect()}
    assert got == {(1, "A"): ("5515555" + "2" + "5" * 4992, "5515"), (1, "B"): ("5" * 5000, "5555"),
                   (2, "A"): ("0" + "5" * 4999, None), (3, "D"): ("2" * 200 + "5" * 4800, "2222")}
