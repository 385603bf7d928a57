import numpy as np
import pytest

from emberledger.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, row string, unit string"


def brute(rows):
    ok = []
    for k, (i, v, l) in enumerate(rows):
        if l is None or not v or None in v:
            continue
        x = np.array(v, "f8")
        if np.isfinite(x).all() and x.any():
            ok.append((k, i, x / np.linalg.norm(x), l))
    links, label = [0] * len(rows), {i: i for i, _, _ in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(ok)):
        for b in range(a):
            (k, i, x, l), (m, j, y, o) = ok[a], ok[b]
            if l == o and len(x) == len(y) and x @ y >= 0.93:
                links[k] += 1
                links[m] += 1
                p, q = find(i), find(j)
                label[max(p, q)] = min(p, q)
    return sorted((i, n, find(i), find(i) == i) for (i, _, _), n in zip(rows, links))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def result(df, **options):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df, **options).collect())


def test_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, [float(x) for x in base + rng.normal(size=8) * 0.15], i % 2) for i in range(30)]
    rows += [(30, None, 0), (31, [], 0), (32, [0.0] * 8, 0), (33, [1.0] * 7 + [None], 0), (34, [float("nan")] * 8, 0),
             (35, [float("inf")] * 8, 0), (36, rows[0][1], None), (0, rows[0][1], 0), (37, [1.0, 2.0], 0), (38, [2.0, 4.0], 0),
             (39, [1e-30] * 8, 1), (40, [3e30] * 8, 1)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    assert result(frame(spark, rows)) == brute(rows)
    assert result(frame(spark, [])) == []


@pytest.mark.parametrize("options", [{}, {"block": 16}])
def test_recall_and_precision(spark, options, monkeypatch):
    """Many tables and blocks against all pairs."""
    monkeypatch.setattr(E, "TARGET", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 32))
    rows = []
    for i in range(400):
        c = centres[0] if i % 3 == 0 else centres[i % 60]
        rows.append((i, [float(np.float32(x)) for x in c + rng.normal(size=32) * 0.2], 0))
    want, got = brute(rows), result(frame(spark, rows), **options)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) > 0.98


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, factors = E.encode(x)
    near, error = E.estimate(codes, factors, x)
    off = near - x @ x.T
    assert abs(off.mean()) < 0.005
    assert (abs(off) < E.SIGMAS * error[None, :] + 1e-4).mean() > 0.999


@pytest.mark.parametrize("options", [{}, {"block": 700}])
def test_no_link_is_lost_in_a_large_label(spark, options):
    """Planted pairs at the threshold and above, by cosine band, against all pairs."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.93, 0.96, (len(x), 1))
    v = np.concatenate([x, c * x + np.sqrt(1 - c**2) * y]).astype("f4")
    u = v.astype("f8")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cosines = u @ u.T
    links = (cosines >= 0.93) & ~np.eye(len(u), dtype=bool)
    got = {r[0]: r for r in result(frame(spark, [(i, w.tolist(), 0) for i, w in enumerate(v)]), **options)}
    bands = {}
    for i, j in zip(*np.nonzero(np.triu(links))):
        lost, n = bands.get(band := int(cosines[i, j] * 100), (0, 0))
        bands[band] = (lost + (got[i][1] < links[i].sum()), n + 1)
    assert sorted(bands) == [93, 94, 95] and min(n for _, n in bands.values()) > 300
    assert {band: lost for band, (lost, _) in bands.items()} == {93: 0, 94: 0, 95: 0}
    assert [got[i][1] for i in range(len(u))] == links.sum(axis=1).tolist()
    assert all(got[j][2] == i for i, j in zip(*np.nonzero(np.triu(links))))
