"""Rows of samples against call blocks and against the measures on cells."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from genospark.operators import linkage, parentage, popgen, samplerows, structure
from genospark.plans.fixtures import Fixtures
from genospark.session import stored

CELLS = "nume_cari long, sample_id string, map_name string, pos int, code int"


def _content(blocks):
    return sorted(str(tuple(r)) for r in blocks.select("map_name", "sample_id", "block", "b0", "b1", "b2", "seen").collect())


def _odd_calls():
    rng = np.random.default_rng(7)
    rows = [(1, "a", "M", k, int(rng.integers(0, 3))) for k in range(300)]
    rows += [(2, "a", "M", k, int(rng.choice([0, 1, 2, 5]))) for k in range(40, 150, 3)]  # a later upload
    rows += [(1, "b", "M", k, k % 3) for k in (3, 700, 5000)] + [(1, "b", "N", 9, 2)]  # gaps
    rows += [(1, "c", "M", k, int(c)) for k in range(70) for c in rng.choice(3, 2)] + [(1, "c", "M", 70, c) for c in range(3)]  # several calls
    return rows + [(None, "d", "M", 3, 1), (1, "e", "M", None, 2), (1, None, "M", 5, 0), (1, "f", None, 5, 0), (1, "g", "M", 6, 4), (1, "g", "M", 7, None)]


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_hold_what_blocks_hold(spark, parts):
    """Uploads, gaps, several calls at a position, nulls; also where a sample's calls lie in several tasks."""
    cells = spark.createDataFrame(_odd_calls(), CELLS).repartition(parts)
    rows = popgen.sample_rows(cells)
    want = popgen.call_blocks(cells)
    assert _content(popgen.call_blocks(rows)) == _content(want)
    assert rows.groupBy("map_name", "sample_id").count().where("count > 1").isEmpty()
    assert popgen.stored_blocks(rows) is rows
    assert sorted(popgen.called_samples(rows).collect(), key=str) == sorted(popgen.called_samples(want).collect(), key=str)
    assert sorted(map(str, popgen.genotypes(rows).collect())) == sorted(map(str, popgen.genotypes(want).collect()))
    assert popgen.sample_rows(cells.limit(0)).isEmpty()


def test_a_sample_is_not_cut_where_calls_are_packed(monkeypatch):
    monkeypatch.setattr(samplerows, "PACKED_CALLS", 100)
    rows = [(1, f"s{k}", "M", p, p % 3) for k in range(3) for p in range(250)] + [(1, "t", "M", p, 0) for p in range(5)]
    table = pa.table(dict(zip(("nume_cari", "sample_id", "map_name", "pos", "code"), map(list, zip(*rows)))))
    out = list(samplerows._pack(iter(table.to_batches(max_chunksize=30))))
    assert [s for b in out for s in b.column("sample_id").to_pylist()] == ["s0", "s1", "s2", "t"]
    assert [n for b in out for n in b.column("n_called").to_pylist()] == [250, 250, 250, 5]


def _herd(spark, n=40, snps=200):
    rng = np.random.default_rng(3)
    alleles = {f"f{k}": rng.integers(0, 2, (2, snps)) for k in range(n)}
    ped = []
    for k in range(n // 2):
        s, d = f"f{rng.integers(n // 2)}", f"f{n // 2 + rng.integers(n // 2)}"
        alleles[f"k{k}"] = np.stack([alleles[x][rng.integers(0, 2, snps), np.arange(snps)] for x in (s, d)])
        ped.append((f"k{k}", s if k % 3 else None, d))
    codes = {s: np.where(rng.random(snps) < 0.05, 5, a.sum(0)) for s, a in alleles.items()}
    ped += [ped[1], ("k0", "f0", "nobody"), ("k2", ped[4][1], ped[4][2])]  # a record twice, an absent parent, two records
    rows = [(1, s, "M", k, int(c)) for s, cs in codes.items() for k, c in enumerate(cs) if s != "f3" or k > 130]
    return spark.createDataFrame(rows, CELLS), spark.createDataFrame(ped, "child string, sire string, dam string")


def _rows(df):
    return sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("size", [1 << 30, 1500])
def test_measures_of_rows_are_those_of_cells(spark, monkeypatch, size):
    """In one pass and in many; records that come twice count twice."""
    cells, ped = _herd(spark)
    rows = popgen.sample_rows(cells)
    monkeypatch.setattr(samplerows, "PASS_BYTES", size)
    monkeypatch.setattr(linkage, "PASS_BYTES", size)
    monkeypatch.setattr(linkage, "CHUNK", 7)
    positions = popgen.seen_positions(rows).withColumn("snp_key", F.col("pos").cast("string"))
    freqs = stored(popgen.allele_frequencies(rows, positions))
    shares = cells.select("sample_id").distinct().withColumns({"grp": F.lit("P"), "share": F.lit(1.0)})
    possible = popgen.parent_pairs(ped).select(F.lit("M").alias("map_name"), "child", F.col("parent").alias("candidate")).unionByName(
        ped.selectExpr("'M' AS map_name", "child", "'f7' AS candidate")).distinct()
    for measure in (lambda c: popgen.allele_frequencies(c, positions), lambda c: popgen.opposing_homozygotes(c, ped),
                    lambda c: parentage.trio_counts(c, ped), lambda c: parentage.assign_parents(c, freqs, possible),
                    lambda c: parentage.parent_search(c, ped, 0.02, 20, 3, 1 << 14), lambda c: structure.group_exclusion(c, shares),
                    lambda c: structure.group_likelihood_ratios(c, shares, ped), lambda c: linkage.pruned_panel(c, freqs, 5, 0.05)):
        want = _rows(measure(cells))
        assert want and _rows(measure(rows)) == want


def test_a_pass_takes_a_part_of_the_keys(spark, monkeypatch):
    cells, ped = _herd(spark)
    rows = popgen.sample_rows(cells)
    monkeypatch.setattr(samplerows, "PASS_BYTES", 1500)
    sizes = [part.select("child").distinct().count() for part in popgen.related_codes(rows, popgen.parent_pairs(ped))]
    assert len(sizes) > 3 and max(sizes) < sum(sizes) == 20


def _files(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_stored_tables_leave_no_shuffle_files(spark):
    before = _files(spark)
    got = stored(spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count())
    assert got.count() == 7
    left = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split(" ")]
    assert _files(spark) <= before + 1, left  # the count's own
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("name", ["fx_family_calls", "fx_population_calls"])
def test_calls_of_samples_are_not_stored(spark, name):
    """They grow with samples x SNPs, and a query reads them once."""
    calls = Fixtures(spark, "/root/testdata/sf0.001").table(name)
    assert calls.count() > 0 and not any(name in f for f in calls.inputFiles())
