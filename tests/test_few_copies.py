"""What encoding writes to disk beside its output."""

from genospark.operators import encode
from genospark.plans.fixtures import Fixtures

SF = "/root/testdata/sf0.001"
CALLS = "nume_cari long, line_no long, sample_id string, snp_name string, a1 string, a2 string, map_name string"


def test_numbered_calls_are_stored_once(spark):
    """Numbered where they are read: there is no second table, and the sorted one has no keys."""
    calls = Fixtures(spark, SF).fx_calls
    files = calls.inputFiles()
    assert any("numbered-parts" in f for f in files) and not any("fixture-fx_calls" in f for f in files)
    parts = spark.read.parquet(*[f for f in files if "numbered-parts" in f])
    assert sorted(parts.columns) == sorted({*calls.columns, "__in", "__at", "__part"} - {"line_no"})
    assert calls.columns[:2] == ["nume_cari", "line_no"] and calls.schema["line_no"].dataType.simpleString() == "bigint"


def _calls(spark):
    rows = [(1, n, "s", f"x{n % 7}", "A", "AB"[n % 2]) for n in range(40)] + [(1, 50, "none", "y", "A", "A"), (2, 1, "bad", "x1", "X", "A")]
    rows += [(2, 2, None, "x2", "B", "B"), (None, 3, "t", "x3", "A", "A"), (2, 4, "s", None, "A", "A")]
    return spark.createDataFrame([(*r, "M") for r in rows], CALLS), spark.createDataFrame(
        [("M", k, f"X{k}") for k in range(5)], "map_name string, id long, snp_name string")


def test_calls_outside_the_map_are_not_shuffled(spark):
    """A sample without a usable call has one row; the others only their placed calls, of which the last one holds."""
    calls, maps = _calls(spark)
    kept = encode.last_calls(calls, encode.map_positions(maps), keep_unplaced=True)
    assert kept.where("pos IS NOT NULL AND code IS NULL").isEmpty()
    got = {(r.nume_cari, r.sample_id): (r.n_called, r.genotype) for r in encode.genotype_strings(calls, maps).collect()}
    assert got[1, "none"] == got[2, "bad"] == got[2, "s"] == (0, "55555") and got[2, None] == (1, "55055") and got[None, "t"] == (1, "55525")
    assert got[1, "s"][0] == 5 and len(got) == 6
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("RepartitionByExpression")[1]
    assert "LeftOuter" not in above and "Inner" in above


def test_a_large_map_gives_the_same_strings(spark, monkeypatch):
    calls, maps = _calls(spark)
    want = sorted(map(str, encode.genotype_strings(calls, maps).collect()))
    monkeypatch.setattr(encode, "MANY_NAMES", 0)
    rows = encode.genotype_strings(calls, maps)
    assert any("placed-calls" in f for f in rows.inputFiles())  # the join's shuffle ends before the next one
    assert sorted(map(str, rows.collect())) == want
