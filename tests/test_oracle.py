"""Every registered query against its DuckDB oracle on the smallest TESTDATA folder."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from genospark.plans.queries import QUERIES
from tools.check_oracle import TABLES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


#: Seeded simulation (tests/test_parentage.py), principal components (tests/test_structure.py).
WITHOUT_SQL = {"x13", "x18"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows(cols, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(E.oracle_sql()) == WITHOUT_SQL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["nume_cari", "campione", "callrate_g", "mappa_usata_g", "genotipo"]
    assert df.count() > 0
