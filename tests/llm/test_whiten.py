from fractions import Fraction

import numpy as np
import pytest

from groundshift.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, x string, dims int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def plain(rows, components=4):
    """Exact fractions on the driver, then ``eigh``."""
    import math

    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    cov = [[sum((Fraction(x[a]) - Fraction(sums[a], n)) * (Fraction(x[b]) - Fraction(sums[b], n)) for x in fit) / n for b in range(dims)] for a in range(dims)]
    values, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in good:
        moved = [n * a - s for a, s in zip(x, sums)]
        w = np.array([m / n for m in moved]) @ axes[:, order] / np.sqrt(values[order])
        out.setdefault(i, []).append((n, sum(m * m for m in moved), w, values[order] / values.sum()))
    return out


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    for bits in (1, 9, 64):
        y = rng.integers(0, 2**bits, (197, 5), np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 2**64 - 1, (197, 5), np.uint64, endpoint=True)
        got = whiten.cross_products(y, bits)
        rows = y.astype(object)
        assert all(got[i][j] == (rows[:, i] * rows[:, j]).sum() for i in range(5) for j in range(i, 5))
        assert whiten.plane_sums(y, bits) == rows.sum(axis=0).tolist()


def test_equals_plain_fractions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * [1, 2, 3, 0.5, 0.2, 0.1]).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a hot vector
    rows += [(2000, None), (2001, [None] + [0.0] * 5), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (7, rows[3][1]), (2004, [1.0])]
    want = plain([r for r in rows if r[0] != 2004])
    got = {}
    for r in whiten.whitened(table(spark, rows)).collect():
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert {i for i, _ in got} == set(want)
    for (i, deviation), parts in got.items():
        n, far, w, share = next(x for x in want[i] if x[1] == deviation)
        assert sorted(parts) == [1, 2, 3, 4] and parts[1].n == n
        for k, r in parts.items():
            assert abs(abs(r.whitened) - abs(w[k - 1])) < 1e-9
            assert r.explained == pytest.approx(share[k - 1], rel=1e-9)
            assert 0 <= r.identity_error < 1e-9


def test_odd_tables(spark):
    assert whiten.whitened(table(spark, [])).collect() == []
    assert whiten.whitened(table(spark, [(1, None), (2, [])])).collect() == []
    one = whiten.whitened(table(spark, [(1, [0.5, -0.25]), (None, [0.5, -0.25])])).collect()
    assert len(one) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in one)
    line = whiten.whitened(table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()  # no spread in one dimension
    assert sorted((r.vec_id, r.component, None if r.whitened is None else abs(round(r.whitened, 12)), r.explained) for r in line) == [
        (1, 1, 1.0, 1.0), (1, 2, None, 0.0), (2, 1, 1.0, 1.0), (2, 2, None, 0.0)
    ]


def test_huge_entries(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e10, 3.0])]
    out = whiten.whitened(table(spark, rows)).collect()
    assert len(out) == 6 and all(r.deviation is None for r in out) and all(r.identity_error < 1e-4 for r in out)
    assert whiten.whole(np.array([3e38, -3e38, 1e10, 2.0**54]), 256.0).tolist() == [2**63 - 1, -(2**63), 2560000000000, 2**62]
