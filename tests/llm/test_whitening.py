"""Whitening against plain rational arithmetic and a direct eigenvalue solution."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from orderloom.llm import whitening
from orderloom.llm.whitening import refined, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, n long, component string, x int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 3, 7, "x", 2) for i, v in rows], SCHEMA).repartition(3)


def spread(seed, n, width):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0.3, 0.05 * (d + 1)) for d in range(width)]) for i in range(n)]


def brute(rows, scale=256):
    """Kept rows, fit list size, sums, exact covariance."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in kept)
    kept = [(i, v + [0] * (width - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mid = [Fraction(s, n) for s in sums]
    cov = [[sum((v[a] - mid[a]) * (v[b] - mid[b]) for v in fit) / n for b in range(width)]
           for a in range(width)]
    return kept, n, sums, cov


AWKWARD = [(None, [0.1] * 5), (None, [0.1] * 5), (900, None), (901, []), (902, [1.0, None]),
           (903, [math.nan] * 5), (904, [math.inf] * 5), (906, [0.25] * 5), (906, [0.25] * 5),
           (905, [1.0, 2.0])]


@pytest.mark.parametrize("run", [4096, 7])
def test_against_rational_arithmetic(spark, monkeypatch, run):
    monkeypatch.setattr(whitening, "ROWS", run)
    rows = spread(1, 150, 5) + spread(1, 20, 5) + AWKWARD
    kept, n, sums, cov = brute(rows)
    values, vectors = np.linalg.eigh(np.array(cov, float))
    got = whiten(spark, table(spark, rows), components=3).collect()
    assert len(got) == 3 * len(kept) and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-12
    want = sorted((i is None, i or 0, k + 1, sum((n * x - s) ** 2 for x, s in zip(v, sums)))
                  for i, v in kept for k in range(3))
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["deviation"])
                  for r in got) == want
    by_row = {}
    for i, v in kept:
        y = np.array([float(x - Fraction(s, n)) for x, s in zip(v, sums)])
        for k in range(3):
            u = vectors[:, -1 - k]
            u = u if u[np.abs(u).argmax()] > 0 else -u
            by_row[i, k + 1] = float(y @ u / math.sqrt(values[-1 - k]))
    for r in got:
        assert r["whitened"] == pytest.approx(by_row[r["vec_id"], r["component"]], abs=1e-10)
        assert r["explained"] == pytest.approx(
            values[-r["component"]] / float(sum(cov[d][d] for d in range(5))), rel=1e-12)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [x * 10.0 ** 12, x * x * 10.0 ** 11]) for i, x in enumerate((1, 2, 3, 9, 10, 11))]
    kept, n, sums, cov = brute(rows)
    got = whiten(spark, table(spark, rows), components=2).collect()
    assert len(got) == 12 and {r["deviation"] for r in got} == {None}
    assert got[0]["identity_error"] < 1e-9


def test_few_or_no_rows_and_no_variance(spark):
    assert whiten(spark, table(spark, [])).collect() == []
    assert whiten(spark, table(spark, AWKWARD[2:3])).collect() == []
    assert whiten(spark, table(spark, [(1, [0.5] * 4), (2, [0.5] * 4)])).collect() == []
    got = whiten(spark, table(spark, [(1, [0.5] * 4), (2, [0.25] * 4)])).collect()
    assert sorted((r["vec_id"], r["component"], r["whitened"]) for r in got) == [
        (1, 1, pytest.approx(1)), (2, 1, pytest.approx(-1))]


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1, 0.5], [1, 1, 1, 1, 1, 1], [3, 1 + 1e-9, 1, 1 - 1e-9, 1e-8, 0],
    [1 + 3e-13, 1 + 2e-13, 1 + 1e-13, 1, 1e-3, 1e-3], [7, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0],
    [1e-30, 5e-31, 1e-31, 0, 0, 0], [2, 1 + 1e-5, 1, 1, 1 - 1e-12, 0.9]])
def test_refined_eigenvectors(values):
    draw = np.random.default_rng(4)
    wide = np.longdouble
    q = np.linalg.qr(draw.normal(size=(6, 6)))[0].astype(wide)
    for _ in range(4):
        q = q + q @ (np.eye(6, dtype=wide) - q.T @ q) / 2
    a = (q * np.array(values, wide)) @ q.T
    a = (a + a.T) / 2
    got, x = refined(a)
    top = float(np.abs(a).max()) or 1.0
    assert np.all(np.diff(got.astype(float)) <= 1e-18 * top)
    assert np.abs(got - np.sort(np.array(values, wide))[::-1]).max() <= 1e-17 * top
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-17
    assert np.abs(a @ x - x * got).max() <= 1e-17 * top
    # Vectors of separate eigenvalues are those the matrix was made of.
    for k, v in enumerate(sorted(values, reverse=True)):
        apart = min([abs(v - w) for w in values if w != v] or [0])
        if values.count(v) == 1 and apart > 1e-14 * top:
            own = q[:, values.index(v)]
            assert min(np.abs(x[:, k] - own).max(), np.abs(x[:, k] + own).max()) \
                < 1e-17 * top / apart


def test_refined_eigenvectors_of_many_dimensions():
    draw = np.random.default_rng(5)
    base = draw.normal(size=(64, 300))
    a = (base @ base.T / 300).astype(np.longdouble)
    values, x = refined(a)
    assert np.abs(x.T @ x - np.eye(64)).max() < 1e-17
    assert np.abs(a @ x - x * values).max() < 1e-17
