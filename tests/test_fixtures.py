"""Inputs that are built over all tasks."""

import random

import pytest

from genospark.plans.fixtures import FIXTURE_SQL, Fixtures, dependencies, numbered_within

SF = "/root/testdata/sf0.001"


def test_numbers_in_groups_come_from_all_tasks(spark):
    """One group of most rows, a null group, null keys: the numbers of the window, in more than one part."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(50)]), k) for k in range(4000)]
    df = spark.createDataFrame(rows, "g int, a int, b int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered_within(df.selectExpr("g", "a", "b"), "g", ["a", "b"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = df.selectExpr("g", "a", "b", "CAST(row_number() OVER (PARTITION BY g ORDER BY a, b) AS BIGINT) AS n")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_calls_are_numbered_without_a_window(spark):
    fx = Fixtures(spark, SF)
    calls = fx.derive("fx_calls")
    plan = calls._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and calls.columns[:2] == ["nume_cari", "line_no"]
    got = {r[0]: r[1:] for r in calls.groupBy("nume_cari").agg({"line_no": "max", "*": "count"}).collect()}
    assert got and all(a == b for a, b in got.values())


def _folder(spark, path, suppliers, parts):
    spark.createDataFrame([(k, ) for k in suppliers], "s_suppkey long").write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{path}/part.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["fx_family_calls", "fx_population_calls"])
def test_calls_of_samples_are_those_of_the_sql(spark, tmp_path, name):
    """Also with keys that come twice or are null; and no call is shuffled."""
    sf = _folder(spark, tmp_path, [*range(60), 4, 4, 6, 9, None, None], [(k, k % 9 if k % 17 else None) for k in range(150)]
                 + [(20, 2), (21, 3), (None, 1)])
    fx = Fixtures(spark, sf)
    got = fx.derive(name)
    want = spark.sql(FIXTURE_SQL[name], **{dep: fx.table(dep) for dep in dependencies(name)})
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join Cross")[0]
    assert "Aggregate" not in above and "Join Inner" not in above


def test_calls_of_large_keys_do_not_overflow(spark, tmp_path):
    big = 60_000_000
    sf = _folder(spark, tmp_path, [*range(0, 8)], [(big + k, 1) for k in range(40)])
    got = {(r.sample_id, r.pos): r.code for r in Fixtures(spark, sf).fx_family_calls.collect()}
    p = 1000003
    for pos in range(40):
        m, k = big + pos, 2
        t = 15 + (m * 37) % 45
        n_a = sum((k * 1009 + m * 9176 + h * 31337) ** 2 % p % 100 < t for h in (1, 2))
        x = (k * 4001 + m * 6007 + 11) ** 2 % p
        want = 5 if x % 50 == 3 else (n_a + 1) % 3 if x % 200 == 7 or (m % 29 == 0 and x % 10 == 1) else n_a
        assert got["SMP2", pos] == want


def test_no_query_reads_the_alleles_of_the_sql(spark, tmp_path, monkeypatch):
    """Two rows for each founder and SNP: a step of the SQL that is not stored beside the calls."""
    fx = Fixtures(spark, _folder(spark, tmp_path, range(8), [(k, 1) for k in range(5)]))
    built = []
    monkeypatch.setattr(Fixtures, "table", lambda self, name: built.append(name))
    fx.prepare()
    assert "fx_family_calls" in built and "fx_family_alleles" not in built
