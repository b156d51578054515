"""Panel pruning against the rule in plain loops, over several ranges and chunks."""

import numpy as np
import pytest

from genospark.operators import linkage, popgen

CELLS = "nume_cari long, sample_id string, map_name string, pos int, code int"


def _frame(spark, codes, name="A"):
    return spark.createDataFrame([(1, f"s{i}", name, int(j), int(c)) for (i, j), c in np.ndenumerate(codes)], CELLS)


def _freqs(cells):
    return popgen.allele_frequencies(cells, cells.selectExpr("map_name", "pos", "concat('S', pos) AS snp_key").distinct())


def _rule(codes, positions, window, max_r2):
    kept, told = [], {}
    for k, j in enumerate(positions):
        for i in (i for i in kept if k - i <= window):
            both = (codes[:, positions[i]] < 3) & (codes[:, j] < 3)
            a, b = codes[both, positions[i]].astype(float), codes[both, j].astype(float)
            if a.std() and b.std() and np.corrcoef(a, b)[0, 1] ** 2 > max_r2:
                told[j] = positions[i]
                break
        else:
            kept.append(k)
    return {int(j): (j not in told, int(told[j]) if j in told else None) for j in positions}


def _linked(rng, n, m):
    """Each SNP copies the one two before it, mostly."""
    codes = rng.binomial(2, 0.4, (n, m))
    for j in range(2, m):
        same = rng.random(n) < (0.9 if j % 7 else 0.2)
        codes[same, j] = codes[same, j - 2]
    codes[rng.random(codes.shape) < 0.02] = 5
    return codes


@pytest.mark.parametrize(("window", "chunk", "max_r2"), [(3, 11, 0.2), (5, 4096, 0.1), (200, 30, 0.3)])
def test_pruned_panel_follows_the_rule(spark, monkeypatch, window, chunk, max_r2):
    monkeypatch.setattr(linkage, "CHUNK", chunk)
    codes = _linked(np.random.default_rng(window), 80, 90)
    codes[:, 10], codes[::2, 20] = 2, 5  # constant; called too rarely
    cells = _frame(spark, codes).unionByName(_frame(spark, codes[:, ::-1], "B"))
    freqs = _freqs(cells)
    rows = linkage.pruned_panel(cells, freqs, window, max_r2).collect()
    for name, mine in (("A", codes), ("B", codes[:, ::-1])):
        positions = [r.pos for r in freqs.where(f"informative AND map_name = '{name}'").orderBy("pos").collect()]
        got = {r.pos: (r.kept, r.told_by) for r in rows if r.map_name == name}
        assert got == _rule(mine, positions, window, max_r2)
        assert 0 < sum(k for k, _ in got.values()) < len(got)
        assert (10 if name == "A" else 79) not in got and (20 if name == "A" else 69) not in got


def test_order_of_the_rule(spark):
    """A dropped SNP drops nobody: of three in a chain the last one stays if only the middle one tells it."""
    assert linkage.pruned_panel(_frame(spark, np.zeros((4, 3), int)), _freqs(_frame(spark, np.zeros((4, 3), int)))).isEmpty()
    rng = np.random.default_rng(0)
    a, c = rng.binomial(2, 0.5, 400), rng.binomial(2, 0.5, 400)
    b = np.where(np.arange(400) % 2, a, c)
    cells = _frame(spark, np.stack([a, b, c], 1))
    got = {r.pos: r.told_by for r in linkage.pruned_panel(cells, _freqs(cells), max_r2=0.15).collect()}
    assert got == {0: None, 1: 0, 2: None}


def test_empty_input(spark):
    cells = spark.createDataFrame([], CELLS)
    assert linkage.pruned_panel(cells, _freqs(cells)).count() == 0
