import numpy as np
import pytest

from emberledger.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n string, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SCHEMA).repartition(parts)


def table(n, dims, seed=0, spread=None):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) * (spread if spread is not None else np.linspace(2, 0.1, dims))
    return [(i, [float(x) for x in row]) for i, row in enumerate(base @ np.linalg.qr(rng.normal(size=(dims, dims)))[0])]


def brute(rows, k):
    """Exact deviations, and numpy's eigenpairs of the same covariance."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array([[a - s / n for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return deviation, e, y @ u / np.sqrt(e), (y * y).sum() / n


@pytest.mark.parametrize("dims,n", [(8, 200), (40, 500), (64, 50)])
def test_against_eigh(spark, dims, n):
    rows = table(n, dims)
    k = min(32, dims, n - 1)
    deviation, e, white, trace = brute(rows, k)
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == n * k and {r.n for r in got} == {n}
    w = np.zeros((n, k))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9)
    sign = np.sign((w * white).sum(axis=0))
    assert np.abs(w * sign - white).max() < 1e-6
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_any_partitioning_gives_the_same_sums(spark):
    rows = table(300, 12, 3)
    one, many = (W.fit(frame(spark, rows, p)) for p in (1, 7))
    assert one.sums == many.sums and (one.values == many.values).all() and one.trace == many.trace


def test_left_out_vectors(spark):
    rows = table(60, 6, 1)
    bad = [(100, None), (101, []), (102, [1.0] * 5 + [None]), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5),
           (105, [1.0, 2.0]), (106, [3e38] * 6)]
    repeated = [rows[0], rows[0], (None, rows[1][1])]
    got = W.whiten(frame(spark, rows + bad + repeated)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows} | {None}
    assert sum(r.vec_id == 0 for r in got) == 3 * 6 and {r.n for r in got} == {63}


def test_equal_eigenvalues_and_low_rank(spark):
    # the corners of a cube: all eigenvalues equal; a fourth column is constant
    rows = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1), 5.0]) for i in range(8)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3} and got[0].identity_error < 1e-9
    assert W.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []


def test_empty(spark):
    out = W.whiten(frame(spark, []))
    assert out.collect() == [] and out.columns[:2] == ["vec_id", "component"]


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**30 * (i % 3)), float(i)]) for i in range(9)]
    deviation, *_ = brute(rows, 2)
    got = {r.vec_id: r.deviation for r in W.whiten(frame(spark, rows)).collect()}
    assert got == {i: d if d < 2**63 else None for i, d in enumerate(deviation)}


def test_inertia_counts():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 30))
    a = a @ a.T
    e = np.linalg.eigvalsh(a)
    points = np.concatenate([(e[1:] + e[:-1]) / 2, [e[0] - 1, e[-1] + 1]])
    assert W.inertia(*W.tridiagonal(a), points).tolist() == [int((e < p).sum()) for p in points]


def test_close_and_spread_eigenvalues():
    rng = np.random.default_rng(6)
    u = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    e = np.sort(np.concatenate([10.0 ** -np.arange(12), 3 + 1e-7 * np.arange(12)]))[::-1]
    v = (u * e) @ u.T
    v = (v + v.T) / 2
    d, off = W.tridiagonal(v)
    parts = W.intervals(d, off, 16, 1e-13)
    pairs = [W.feast(v, lo, hi, n) for lo, hi, n in parts]
    values = np.sort(np.concatenate([p[0] for p in pairs]))[::-1]
    assert len(values) >= 16 and np.abs(values[:16] - np.linalg.eigvalsh(v)[::-1][:16]).max() < 1e-12
