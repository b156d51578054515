"""Principal components against a dense solution, group-aware measures against plain sums."""

import math

import numpy as np
import pytest

from genospark.operators import popgen, structure

CELLS = "nume_cari long, sample_id string, map_name string, pos int, code int"
SHARES = "sample_id string, grp string, share double"


def _frame(spark, codes, name="A"):
    return spark.createDataFrame([(1, f"s{i:03d}", name, int(j), int(c)) for (i, j), c in np.ndenumerate(codes)], CELLS)


def _freqs(cells):
    return popgen.allele_frequencies(cells, cells.selectExpr("map_name", "pos", "'S' AS snp_key").distinct())


def _populations(rng, n, m, groups=3):
    """Genotypes of three groups with some missing calls, a constant SNP and one never called."""
    p = np.clip(rng.uniform(0.1, 0.9, (groups, m)), 0.05, 0.95)
    codes = rng.binomial(2, p[np.arange(n) % groups])
    codes[rng.random(codes.shape) < 0.03] = 5
    codes[:, 3], codes[:, 5] = 2, 5
    return codes


def _dense(codes):
    seen = codes < 3
    with np.errstate(invalid="ignore", divide="ignore"):
        p = np.where(seen, codes, 0).sum(0) / (2 * seen.sum(0))
        x = np.where(seen & (p > 0) & (p < 1), (codes - 2 * p) / np.sqrt(2 * p * (1 - p)), 0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    return u * s, s * s


def test_components_equal_the_dense_ones(spark, monkeypatch):
    monkeypatch.setattr(structure, "SNP_BLOCK", 16)  # several blocks of sums
    codes = _populations(np.random.default_rng(5), 90, 150)
    cells = _frame(spark, codes).repartition(5)
    found = structure.principal_components(cells, _freqs(cells), k=2)
    scores, variances = _dense(codes)
    axes = found.axes.orderBy("component").collect()
    assert [a.component for a in axes] == [1, 2] and max(a.residual for a in axes) < 1e-6 and found.rounds < 60
    for a, v in zip(axes, variances):
        assert math.isclose(a.variance, v, rel_tol=1e-6) and math.isclose(a.share, v / variances.sum(), rel_tol=1e-6)
    got = np.array([r.scores for r in found.scores.orderBy("sample_id").collect()])
    for k in range(2):
        want = scores[:, k] * np.sign(scores[0, k] * got[0, k])
        assert np.abs(got[:, k] - want).max() < 1e-3 * np.abs(want).max()
    # the two axes tell the three groups apart
    centres = np.array([got[g::3].mean(0) for g in range(3)])
    assert (np.linalg.norm(got[:, None] - centres, axis=2).argmin(1) == np.arange(90) % 3).all()


def test_components_of_small_and_several_maps(spark):
    cells = _frame(spark, np.array([[0, 2], [1, 2], [2, 2]]), "tiny").unionByName(
        _frame(spark, np.array([[2, 2], [2, 2]]), "constant")).unionByName(
        _frame(spark, _populations(np.random.default_rng(1), 30, 40), "large"))
    found = structure.principal_components(cells, _freqs(cells), k=2, max_rounds=5)
    by_map = {}
    for r in found.axes.collect():
        by_map.setdefault(r.map_name, []).append(r.component)
    assert {k: sorted(v) for k, v in by_map.items()} == {"tiny": [1], "large": [1, 2]} and found.rounds == 5
    tiny = {r.sample_id: r.scores for r in found.scores.where("map_name = 'tiny'").collect()}
    assert np.allclose([tiny[f"s00{i}"][0] for i in range(3)], [-math.sqrt(2), 0, math.sqrt(2)])
    empty = structure.principal_components(cells.limit(0), _freqs(cells.limit(0)))
    assert empty.rounds == 0 and empty.scores.isEmpty() and empty.axes.isEmpty()


def test_repeated_runs_give_the_same_scores(spark):
    cells = _frame(spark, _populations(np.random.default_rng(2), 40, 60)).repartition(4, "sample_id")
    runs = [sorted(map(tuple, (tuple([r.sample_id, *r.scores]) for r in
                               structure.principal_components(cells, _freqs(cells), k=1).scores.collect()))) for _ in range(2)]
    assert [r[0] for r in runs[0]] == [r[0] for r in runs[1]]
    assert np.allclose([r[1] for r in runs[0]], [r[1] for r in runs[1]], atol=1e-9)


@pytest.fixture(scope="module")
def mixed(spark):
    """Samples 0-9 of P, 10-19 of Q, 20 half of each, 21 of a group that nobody else has, 22 of none."""
    rng = np.random.default_rng(3)
    p = np.array([[0.2] * 30, [0.8] * 30])
    codes = rng.binomial(2, np.vstack([p[0]] * 10 + [p[1]] * 10 + [p.mean(0)] * 3))
    codes[rng.random(codes.shape) < 0.05] = 5
    codes[21, 0] = 5  # the group of 21 has no frequency there
    shares = [(f"s{i:03d}", "P" if i < 10 else "Q", 1.0) for i in range(20)]
    shares += [("s020", "P", 0.5), ("s020", "Q", 0.5), ("s021", "own", 1.0), ("s022", None, 1.0), ("s022", "P", 0.0),
               ("not genotyped", "P", 1.0)]
    return codes, _frame(spark, codes), shares, spark.createDataFrame(shares, SHARES)


def _own(codes, shares):
    """Frequencies by sample, in plain loops."""
    out = {}
    known = [(s, g, x) for s, g, x in shares if g and x]
    p = {}
    for g in {g for _, g, _ in known}:
        for j in range(codes.shape[1]):
            calls = [(x, codes[int(s[1:]), j]) for s, h, x in known if h == g and s[0] == "s" and codes[int(s[1:]), j] < 3]
            if calls:
                p[g, j] = sum(x * c for x, c in calls) / (2 * sum(x for x, _ in calls))
    for s in {s for s, _, _ in known}:
        mine = [(g, x) for t, g, x in known if t == s]
        out[s] = {j: sum(x * p[g, j] for g, x in mine) / sum(x for _, x in mine) for j in range(codes.shape[1])
                  if all((g, j) in p for g, _ in mine)}
    return out


def test_exclusion_at_own_frequencies(mixed):
    codes, cells, shares, frame = mixed
    got = {r.sample_id: (r.n_snps, r.pe_combined) for r in structure.group_exclusion(cells, frame).collect()}
    own = _own(codes, shares)
    want = {}
    for s, p in own.items():
        p = [x for x in p.values() if 0 < x < 1]
        if s != "not genotyped" and p:
            want[s] = len(p), 1 - math.prod(1 - 2 * x * x * (1 - x) * (1 - x) for x in p)
    assert set(got) == set(want) and "s022" not in got
    assert all(got[s][0] == want[s][0] and math.isclose(got[s][1], want[s][1], rel_tol=1e-9) for s in want)


def test_likelihood_at_own_frequencies(spark, mixed):
    codes, cells, shares, frame = mixed
    pedigree = spark.createDataFrame([("s020", "s001", "s011"), ("s002", "s003", None), ("s022", "s001", None)],
                                     "child string, sire string, dam string")
    got = {(r.child, r.parent): (r.n_snps, r.lod) for r in structure.group_likelihood_ratios(cells, frame, pedigree).collect()}
    own = _own(codes, shares)
    assert set(got) == {("s020", "s001"), ("s020", "s011"), ("s002", "s003")}
    for (child, parent), (n, lod) in got.items():
        terms = []
        for j, p in own[child].items():
            c, g = codes[int(child[1:]), j], codes[int(parent[1:]), j]
            if c < 3 and g < 3 and 0 < p < 1:
                base = [(1 - p) ** 2, 2 * p * (1 - p), p * p][c]
                chance = {0: [1 - p, p, 0], 1: [(1 - p) / 2, 0.5, p / 2], 2: [0, 1 - p, p]}[g][c]
                terms.append(math.log((0.99 * chance + 0.01 * base) / base))
        assert n == len(terms) and math.isclose(lod, sum(terms), rel_tol=1e-9, abs_tol=1e-9)


def test_one_group_is_the_plain_likelihood(spark, mixed):
    codes, cells, _, _ = mixed
    one = spark.createDataFrame([(f"s{i:03d}", "all", 1.0) for i in range(len(codes))], SHARES)
    pedigree = spark.createDataFrame([("s020", "s001", "s011")], "child string, sire string, dam string")
    plain = {r.parent: (r.n_snps, r.lod) for r in popgen.likelihood_ratios(cells, _freqs(cells), pedigree).collect()}
    grouped = {r.parent: (r.n_snps, round(r.lod, 4)) for r in structure.group_likelihood_ratios(cells, one, pedigree).collect()}
    assert plain == grouped


def test_too_many_frequencies_are_refused(mixed, monkeypatch):
    monkeypatch.setattr(structure, "MOST_FREQUENCIES", 10)
    with pytest.raises(ValueError, match="fewer maps"):
        structure.group_exclusion(mixed[1], mixed[3])
