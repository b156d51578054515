"""Contradictions, generations, inbreeding and relationship against the tabular method, on odd pedigrees."""

import random

import pytest

from genospark.operators import pedigree as P

PED = "child string, sire string, dam string"


def tabular(records):
    """Relationship of all pairs by the tabular method; parents come before children in ``records``."""
    parents = {c: (s, d) for c, s, d in records}
    order = []

    def visit(x):
        if x is not None and x not in order:
            for p in parents.get(x, ()):
                visit(p)
            order.append(x)
    for c, _, _ in records:
        visit(c)
    a = {}
    for k, x in enumerate(order):
        s, d = parents.get(x, (None, None))
        for y in order[:k]:
            a[x, y] = a[y, x] = sum(a[p, y] for p in (s, d) if p is not None) / 2
        a[x, x] = 1 + (a[s, d] / 2 if s is not None and d is not None else 0)
    return a


def test_coefficients_equal_the_tabular_method(spark):
    rng = random.Random(3)
    records = []
    for k in range(4, 40):
        s, d = rng.randrange(max(0, k - 9), k), rng.randrange(max(0, k - 9), k)
        records.append((f"i{k}", *(None if rng.random() < 0.1 else f"i{p}" for p in (s, d))))  # selfing included
    want = tabular(records)
    got = P.coefficients(spark.createDataFrame(records, PED))
    names = sorted({x for x, _ in want})
    pairs = spark.createDataFrame([(x, y) for x in names for y in names], "sample_1 string, sample_2 string")
    found = {(r.sample_1, r.sample_2): r.relationship for r in got.relationships(pairs).collect()}
    assert found.keys() == want.keys() and all(abs(found[p] - want[p]) < 1e-12 for p in want)
    inbred = {r.sample: r.inbreeding for r in got.members.collect()}
    assert all(abs(inbred[x] - want[x, x] + 1) < 1e-12 for x in names) and max(inbred.values()) > 0.3


def test_contradictions(spark):
    records = [("a", "b", None), ("b", "c", "x"), ("c", "a", None),  # a cycle of three, a child below it
               ("k", "a", "x"), ("self", "self", "x"), ("twice", "y", "y"), ("two", "s", "x"), ("two", "t", "x"),
               ("two", "t", "x"), ("mix", "x", None), (None, "s", "x"), ("none", None, None),
               ("p", "q", None), ("q", "p", "r"), ("m", "p", None), ("r", None, "n"), ("n", "r", None), ("m2", "m", "none")]
    df = spark.createDataFrame(records, PED)
    got = sorted(tuple(r) for r in P.contradictions(df).collect())
    assert got == sorted([
        *[(x, "own_ancestor", 3) for x in "abc"], ("self", "own_ancestor", 1), *[(x, "own_ancestor", 2) for x in "pqrn"],
        ("twice", "one_parent_twice", 1), ("two", "several_records", 2),
        ("x", "sire_and_dam", 1), ("y", "sire_and_dam", 1), ("r", "sire_and_dam", 1)])
    found = {r.sample: r.generation for r in P.generations(df).collect()}
    assert found == {"x": 0, "y": 0, "s": 0, "t": 0, "none": 0, "twice": 1, "two": 1, "mix": 1}
    members = {r.sample: (r.generation, r.inbreeding) for r in P.coefficients(df).members.collect()}
    assert members == {s: (g, 0.5 if s == "twice" else 0.0) for s, g in found.items()}


@pytest.mark.parametrize("records", [[], [(None, None, None)]])
def test_empty_pedigrees(spark, records):
    df = spark.createDataFrame(records, PED)
    assert P.contradictions(df).count() == P.generations(df).count() == 0
    got = P.coefficients(df)
    assert got.members.count() == got.relationships(P.recorded_pairs(df)).count() == 0


def test_a_chain_of_generations_and_a_popular_sire(spark):
    chain = [(f"c{k}", f"c{k - 1}", None) for k in range(1, 6)]
    records = chain + [(f"k{k}", "c0", f"d{k}") for k in range(300)]
    df = spark.createDataFrame(records, PED)
    found = {r.sample: r.generation for r in P.generations(df).collect()}
    assert [found[f"c{k}"] for k in range(6)] == list(range(6)) and found["k7"] == 1
    pairs = spark.createDataFrame([("k1", "k2"), ("c5", "c0"), ("k1", "k2"), ("d1", "d2"), ("k1", "no")],
                                  "sample_1 string, sample_2 string")
    got = {(r.sample_1, r.sample_2): r.relationship for r in P.coefficients(df).relationships(pairs).collect()}
    assert got == {("k1", "k2"): 0.25, ("c5", "c0"): 0.5 ** 5, ("d1", "d2"): 0.0}


def test_contributions_are_packed_rows_of_parents(spark):
    """Of samples that are nobody's parent only the inbreeding is kept, and their relationships are those of the tabular method."""
    rng = random.Random(5)
    records = [(f"g{g}_{k}", f"g{g - 1}_{rng.randrange(4)}", f"g{g - 1}_{rng.randrange(4, 8)}") for g in range(1, 5) for k in range(8)]
    records += [(f"leaf{k}", f"g4_{rng.randrange(4)}", f"g{rng.randrange(2, 5)}_{rng.randrange(4, 8)}") for k in range(20)]
    got = P.coefficients(spark.createDataFrame(records, PED))
    parents = {p for _, s, d in records for p in (s, d)}
    assert sorted(r.sample for r in got.contributions.collect()) == sorted(parents)
    want = tabular(records)
    pairs = spark.createDataFrame([p for p in want if p[0].startswith("leaf")], "sample_1 string, sample_2 string")
    found = {(r.sample_1, r.sample_2): r.relationship for r in got.relationships(pairs).collect()}
    assert len(found) == 20 * len({x for x, _ in want}) and all(abs(found[p] - want[p]) < 1e-12 for p in found)
