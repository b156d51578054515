"""Population measures on samples of several uploads and maps, and on odd pedigrees."""

import math

import numpy as np

from genospark.operators import popgen

CELLS = "nume_cari long, sample_id string, map_name string, pos int, code int"
PED = "child string, sire string, dam string"


def _cells(spark):
    rows = []
    for pos, (c, s) in enumerate([(0, 2), (2, 2), (1, 0), (0, 0)]):
        rows += [(1, "kid", "A", pos, c), (1, "dad", "A", pos, s)]
    rows += [(2, "kid", "A", 0, 2), (2, "kid", "A", 1, 5)]  # a later upload: position 0 corrected, 1 not called
    rows += [(3, "kid", "B", 0, 0), (3, "dad", "B", 7, 2), (3, "dad", "B", 0, 5)]  # another map, no position in common
    return spark.createDataFrame(rows, CELLS)


def test_one_call_per_sample_and_map(spark):
    got = {(r.map_name, r.sample_id, r.pos): r.code for r in popgen.current_calls(_cells(spark)).collect()}
    assert got[("A", "kid", 0)] == 2 and got[("A", "kid", 1)] == 2 and ("B", "dad", 0) not in got


def test_opposing_homozygotes_stay_within_a_map(spark):
    ped = spark.createDataFrame([("kid", "dad", None)], PED)
    got = {r.map_name: (r.n_compared, r.n_opposing) for r in popgen.opposing_homozygotes(_cells(spark), ped).collect()}
    assert got == {"A": (4, 0), "B": (0, 0)}


def test_call_rate_counts_a_sample_once(spark):
    positions = spark.createDataFrame([("A", k, f"S{k}") for k in range(4)] + [("B", 0, "T0"), ("B", 7, "T7")],
                                      "map_name string, pos int, snp_key string")
    got = {(r.map_name, r.pos): (r.n_called, r.n_samples, r.call_rate)
           for r in popgen.allele_frequencies(_cells(spark), positions).collect()}
    assert got[("A", 0)] == (2, 2, 1.0) and got[("B", 0)] == (1, 2, 0.5) and max(v[2] for v in got.values()) <= 1


def test_likelihood_over_blocks(spark):
    """200 positions in several blocks against the plain sum."""
    rows = [(1, s, "A", k, (k * (3 + i)) % 3) for i, s in enumerate(("kid", "dad", "other")) for k in range(200)]
    cells = spark.createDataFrame(rows, CELLS)
    positions = spark.createDataFrame([("A", k, f"S{k}") for k in range(200)], "map_name string, pos int, snp_key string")
    ped = spark.createDataFrame([("kid", "dad", None)], PED)
    got = popgen.likelihood_ratios(cells, popgen.allele_frequencies(cells, positions), ped).first()
    code = {(s, k): c for _, s, _, k, c in rows}
    lod, n = 0.0, 0
    for k in range(200):
        p = sum(code[s, k] for s in ("kid", "dad", "other")) / 6
        if not 0 < p < 1:
            continue
        q, c, g = 1 - p, code["kid", k], code["dad", k]
        prior = [q * q, 2 * p * q, p * p][c]
        trans = {2: [0, q, p], 1: [q / 2, 0.5, p / 2], 0: [q, p, 0]}[g][c]
        lod, n = lod + math.log((0.99 * trans + 0.01 * prior) / prior), n + 1
    assert got.n_snps == n and abs(got.lod - lod) < 1e-3


def test_packed_calls_grow_with_the_calls(spark):
    """A few calls on a map of a million positions: no byte for each position."""
    rows = [(1, s, "A", k * 100_003, (k * (3 + i)) % 3) for i, s in enumerate(("kid", "dad", "other")) for k in range(10)]
    cells = spark.createDataFrame(rows, CELLS)
    assert max(len(r.codes) for r in popgen.genotypes(cells).collect()) < 100
    codes = popgen.packed(np.array([900, 7, 12]), np.array([2, 0, 1]))
    assert [a.tolist() for a in popgen.calls_of(codes)] == [[7, 12, 900], [0, 1, 2]]
    assert popgen.padded(codes, 14).tolist() == [5] * 7 + [0] + [5] * 4 + [1, 5]
    dense = popgen.packed(np.array([2, 0]), np.array([2, 1]))
    assert [a.tolist() for a in popgen.calls_of(dense)] == [[0, 2], [1, 2]] and popgen.padded(dense, 2).tolist() == [1, 5]
    near = [(u, s, m, k // 100_003, c) for u, s, m, k, c in rows]
    found = []
    for some in (rows, near):
        cells = spark.createDataFrame(some, CELLS)
        positions = cells.selectExpr("map_name", "pos", "CAST(pos AS STRING) AS snp_key").distinct()
        ped = spark.createDataFrame([("kid", "dad", None)], PED)
        found.append(tuple(popgen.likelihood_ratios(cells, popgen.allele_frequencies(cells, positions), ped).first()))
    assert found[0] == found[1] and found[0][4] > 3


def test_ancestors_of_a_deep_pedigree(spark):
    """Deeper than any fixed number of rounds, with a cycle at its top."""
    n = 70
    ped = [(f"p{k}", f"p{k + 1}", None) for k in range(n)] + [(f"p{n}", "x", "y"), ("x", "y", None), ("y", "x", None)]
    got = {(r["sample"], r["ancestor"]): r["generation"]
           for r in popgen.ancestors(spark.createDataFrame(ped, PED)).collect()}
    assert all(got[("p0", f"p{k}")] == k for k in range(1, n + 1))
    assert got[("p0", "x")] == got[("p0", "y")] == n + 1 and got[("x", "x")] == 2


def test_siblings_with_unknown_parents(spark):
    ped = spark.createDataFrame([("a", "s", "d"), ("b", "s", "d"), ("c", "s", "e"), ("f", "s", None), ("g", None, "d"),
                                 ("h", None, None)], PED)
    got = {r.child: (r.n_full_sibs, r.n_paternal_half_sibs, r.n_paternal_unresolved, r.n_maternal_half_sibs,
                     r.n_maternal_unresolved) for r in popgen.sibling_counts(ped).collect()}
    assert got == {"a": (1, 2, 1, 1, 1), "b": (1, 2, 1, 1, 1), "c": (0, 3, 1, 0, 0), "f": (0, 3, 3, 0, 0),
                   "g": (0, 0, 0, 2, 2), "h": (0, 0, 0, 0, 0)}


def test_exact_hardy_weinberg(spark):
    """Against sums of factorials in whole numbers; counts from one allele to a large deficit."""
    def exact(bb, ab, aa):
        a, b, n = 2 * aa + ab, 2 * bb + ab, bb + ab + aa
        ways = {h: 2 ** h * math.factorial(n) // (math.factorial(h) * math.factorial((a - h) // 2) * math.factorial((b - h) // 2))
                for h in range(a % 2, min(a, b) + 1, 2)}
        return sum(w for w in ways.values() if w <= ways[ab]) / sum(ways.values())
    counts = [(0, 0, 5), (7, 0, 0), (0, 1, 0), (1, 0, 1), (3, 4, 3), (10, 3, 10), (50, 0, 50), (0, 60, 0), (2, 57, 213), (30, 41, 9),
              (1, 2, 0), (0, 9, 4), (100, 190, 110), (5, 5, 5), (12, 0, 1)]
    df = spark.createDataFrame([("M", k, f"s{k}", *c, sum(c)) for k, c in enumerate([*counts, (0, 0, 0), (40000, 0, 40000)])],
                               "map_name string, pos int, snp_name string, n0 long, n1 long, n2 long, n_called long")
    got = {r.pos: (r.p_value, r.f) for r in popgen.hardy_weinberg(df).collect()}
    for k, c in enumerate(counts):
        assert math.isclose(got[k][0], exact(*c), rel_tol=1e-9), c
    assert len(counts) not in got and got[len(counts) + 1] == (0.0, 1.0)  # no calls; beyond a double
    assert got[0][1] is None and math.isclose(got[7][1], -1.0)


def test_call_blocks_hold_the_latest_calls_and_are_few(spark):
    """A row for each 64 positions: later uploads hold where they called, no-calls are seen, uploads without id count for nothing."""
    rows = [(1, "a", "M", k, k % 3) for k in range(200)] + [(2, "a", "M", k, 5 if k % 2 else 2) for k in range(0, 70)]
    rows += [(1, "b", "M", 130, 5), (None, "c", "M", 3, 1)]
    cells = spark.createDataFrame(rows, "nume_cari long, sample_id string, map_name string, pos int, code int")
    blocks = popgen.stored_blocks(cells)
    assert blocks.count() == 4 + 1 + 1 and popgen.call_blocks(blocks) is blocks
    want = {("M", "a", k): 2 if k < 70 and k % 2 == 0 else k % 3 for k in range(200)}
    got = {(r.map_name, r.sample_id, k): c for r in popgen.genotypes(blocks).collect()
           for k, c in zip(*map(list, popgen.calls_of(bytes(r.codes))), strict=True)}
    assert got == want
    counts = {r.pos: (r.n0, r.n1, r.n2) for r in popgen.genotype_counts(blocks).collect()}
    assert counts == {k: tuple(int(want["M", "a", k] == c) for c in range(3)) for k in range(200)}
    assert sorted(r.pos for r in popgen.seen_positions(blocks).collect()) == list(range(200))
    # every measure reads blocks in place of calls, and adds them up before the shuffle
    plan = popgen.call_blocks(cells)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan
