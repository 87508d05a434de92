import math
import random

import numpy as np
import pytest

from urbanlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, component int, `a.b` string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1, "z") for i, v in rows], SCHEMA)


def brute(rows, k=8):
    """(ids, grid, sums, eigenvalues, eigenvectors, trace) by numpy over the usable vectors."""
    fit = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in fit])
    y = x - x.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / len(x))
    return [i for i, _ in fit], x, x.sum(axis=0), e[::-1][:k], u[:, ::-1][:, :k], np.trace(y.T @ y / len(x))


def vectors(n, width, seed=1):
    rng = np.random.RandomState(seed)
    return [(i, (rng.normal(size=width) * np.linspace(0.5, 2, width)).tolist()) for i in range(n)]


def test_equals_numpy(spark):
    rows = vectors(300, 12)
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (900, None), (901, [1.0, None] + [0.0] * 10), (902, [float("nan")] * 12)]
    rows += [(903, [float("-inf")] * 12), (904, [])]
    ids, x, sums, values, u, trace = brute(rows)
    got = whitening.whiten(table(spark, rows).repartition(3)).collect()
    assert len(got) == len(ids) * 8
    n = len(x)
    want = {}
    for i, row in zip(ids, x.tolist()):
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(row, sums))
        z = (np.array(row) - sums / n) @ u / np.sqrt(values)
        want.setdefault(i, []).append((deviation, z))
    by_id = {}
    for r in got:
        assert r.n == n and r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9) and r.identity_error < 1e-9
        by_id.setdefault((r.vec_id, int(r.deviation)), []).append((r.component, r.whitened))
    signs = None
    for i, found in want.items():
        for deviation, z in found:
            own = [w for _, w in sorted(by_id[i, deviation])][:: len([d for d, _ in found if d == deviation])]
            signs = np.sign(own * z) if signs is None else signs
            assert np.allclose(np.array(own) * signs, z, atol=1e-7), i


def test_few_rows_and_widths(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).collect() == []
    two = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [9.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in two) == [(1, 1, 2), (2, 1, 2)]  # one direction, one width
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1) for r in two)


def test_sums_beyond_a_long_stay_exact(spark):
    rows = [(i, [2.0**29 - i, -(2.0**29) + 3 * i * i]) for i in range(6)]
    ids, x, sums, *_ = brute(rows)
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(table(spark, rows)).collect()}
    assert got == {i: sum((6 * a - int(s)) ** 2 for a, s in zip(row, sums)) for i, row in zip(ids, x.tolist())}
    with pytest.raises(Exception, match="entry of"):
        whitening.whiten(table(spark, [(1, [1e12, 0.0]), (2, [0.0, 1.0])])).collect()


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.RandomState(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


SPECTRA = [
    list(range(1, 41)),
    [100.0] * 3 + [50.0] * 20 + [1.0] * 10,  # equal eigenvalues over the edge
    [1e6, 1e3, 1.0, 1e-3, 0, 0, 0],
    [5.0] * 12,
    [1 + 1e-7 * i for i in range(20)],
    [0.0] * 4,
    [3.0],
]


@pytest.mark.parametrize("spectrum", SPECTRA)
def test_inertia_and_intervals(spectrum):
    v = symmetric(spectrum)
    for shift in (0.5, 2.5, 49.0, 99.9999, 1e5):
        assert whitening.inertia(v, shift) == sum(x > shift for x in spectrum)
    parts = whitening.intervals(v, 8)
    above = sorted((x for x in spectrum if x > max(spectrum) * len(spectrum) * 1e-14), reverse=True)
    assert sum(n for *_, n in parts) >= min(8, len(above))
    for low, high, n in parts:
        assert n == sum(low < x < high for x in spectrum)


@pytest.mark.parametrize("spectrum", SPECTRA)
def test_components_of_hard_spectra(spark, spectrum):
    v = symmetric(spectrum)
    values, u = whitening.leading_components(spark, v, 8)
    above = sorted((x for x in spectrum if x > max(spectrum) * len(spectrum) * 1e-13), reverse=True)[:8]
    assert np.allclose(values, above, rtol=1e-9, atol=1e-12 * max(spectrum))
    assert np.allclose(u.T @ u, np.eye(len(above)), atol=1e-12)
    assert np.abs(v @ u - u * values).max(initial=0) <= 1e-12 * max(spectrum) * len(spectrum)


def test_one_projection_keeps_the_interval_and_damps_the_rest(spark):
    v = np.diag([1.0, 2.0, 3.0, 10.0])
    jobs = [(0, z, w) for z, w in whitening.contour(1.5, 3.5)]
    q = whitening.project(spark, v, [np.eye(4)], jobs)[0]
    assert np.allclose(np.diag(q)[1:3], 1, atol=1e-3) and abs(q[0, 0]) < 1e-3 and abs(q[3, 3]) < 1e-8


def test_missing_vectors_are_noticed(spark, monkeypatch):
    """A projection that returns one and the same plane holds too few of them."""
    monkeypatch.setattr(whitening, "project", lambda spark, v, blocks, jobs: [np.eye(len(v))[:, :2] for _ in blocks])
    with pytest.raises(RuntimeError, match="inertia"):
        whitening.leading_components(spark, symmetric(list(range(1, 41))), 8)


def test_products_are_exact_whatever_their_size():
    rng = random.Random(5)
    for top in (10, 1 << 20, 1 << 40):
        y = np.array([[rng.randrange(-top, top) for _ in range(3)] for _ in range(50)])
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(y).tolist() == want
