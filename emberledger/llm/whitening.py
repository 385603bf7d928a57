"""Embedding whitening by FEAST contour integration.

The covariance of the vectors is summed exactly: entries are integers
(``floor(64 c) + 1000000``), so partial sums of the tasks agree whatever the
partitions are. What the driver holds has the size of the covariance, never of
the data. Its leading eigenpairs come from a spectral slicing:

1. A Householder reduction to tridiagonal form gives inertia counts (how many
   eigenvalues lie below a point, by Sturm sequences) at any point.
2. Bisection on these counts cuts the wanted part of the spectrum, at gaps,
   into intervals of a few eigenvalues each.
3. Every interval is a row of a small Spark table. Its task filters a block of
   start vectors by a contour integral around the interval: Gauss-Legendre
   quadrature of solves with the complex shifted covariance. Rayleigh-Ritz in
   the filtered space gives eigenpairs, and the filter is applied again until
   their residuals vanish.
4. The inertia counts tell how many eigenpairs each interval must give; a
   missing one widens the block and in the end raises.

A last Rayleigh-Ritz over all intervals makes the components orthogonal to
each other to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Eigenvalues of an interval, about; quadrature nodes on the upper half of a contour.
PER_INTERVAL, NODES = 6, 8
#: Applications of the filter; residual, relative to the largest eigenvalue.
ROUNDS, RESIDUAL = 12, 1e-14
#: Entries beyond this are no longer exact as doubles; such a vector is left out like one that is not finite.
MOST = 2.0**52
_EXACT = 2**53


# -- exact sums -----------------------------------------------------------


def _entries(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors remain, and their integer entries less ``SHIFT``."""
    n = len(column)
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    whole = sizes == dims
    flat = column.filter(pa.array(whole)).flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    y = np.floor(SCALE * values)
    good = (np.abs(y) < MOST).all(axis=1)  # false for NaN and infinities
    rows = np.flatnonzero(whole)[good] if n else np.zeros(0, "i8")
    return rows, y[good]


def _gram(y: np.ndarray, total: np.ndarray) -> None:
    """Add the exact ``y' y`` of integer rows to ``total`` (Python integers).
    Products are summed as doubles only while they stay below 2^53."""
    most = float(np.abs(y).max(initial=0))
    rows = int(min(len(y), _EXACT // max(1.0, most * most))) if most else len(y)
    if rows:
        for lo in range(0, len(y), rows):
            part = y[lo : lo + rows]
            total += (part.T @ part).astype("i8").astype(object)
        return
    wide = y.astype("i8").astype(object)
    total += wide.T @ wide


def _sums(vectors: DataFrame, dims: int, centre: list[int] | None) -> tuple[int, list]:
    """Exact count and sums over all remaining vectors: of the entries
    (``centre`` None), or of the products of entries less ``centre``. A task
    sends one row per entry of its sum."""
    width = dims if centre is None else dims * dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims if centre is None else (dims, dims), object)
        for batch in batches:
            _, y = _entries(batch.column(0), dims)
            n += len(y)
            if centre is None:
                for lo in range(0, len(y), 1 << 10):  # 2^10 entries below 2^52 fit a long
                    total += y[lo : lo + (1 << 10)].astype("i8").sum(axis=0).astype(object)
            else:
                _gram(y - np.array(centre, "f8"), total)
        if n:
            flat = [n, *total.ravel().tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, width), pa.int32()), pa.array([str(v) for v in flat])], names=["at", "v"]
            )

    parts = vectors.mapInArrow(run, "at int, v string").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r[0]: int(r[1]) for r in parts.collect()}  # dims * dims + 1 numbers at most
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


# -- spectrum -------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the
    symmetric ``a``, by Householder reflections."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        q = p - (x @ p) * x
        rest -= 2 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(d: np.ndarray, e: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each point:
    the negative pivots of the matrix less the point."""
    points = np.asarray(points, "f8")
    tiny = np.finfo("f8").tiny * max(1.0, float((e * e).max(initial=0)))
    below = np.zeros(points.shape, "i8")
    pivot = np.full(points.shape, np.inf)
    for i in range(len(d)):
        pivot = d[i] - points - (e[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def _gap(d: np.ndarray, e: np.ndarray, lo: float, hi: float) -> float:
    """A point between ``lo`` and ``hi`` that lies far from the eigenvalues:
    the middle of the widest free stretch of a fine grid."""
    grid = np.linspace(lo, hi, 65)
    count = inertia(d, e, grid)
    free = np.flatnonzero(count[1:] == count[:-1])
    if not len(free):
        return (lo + hi) / 2
    edge = np.flatnonzero(np.diff(free) > 1)
    starts, ends = np.append(0, edge + 1), np.append(edge, len(free) - 1)
    width = free[ends] - free[starts]
    middle = np.abs((free[ends] + free[starts]) / 2 - 31.5)
    best = np.lexsort((middle, -width))[0]
    return float((grid[free[starts[best]]] + grid[free[ends[best]] + 1]) / 2)


def intervals(d: np.ndarray, e: np.ndarray, wanted: int, floor: float) -> list[tuple[float, float, int]]:
    """Intervals above ``floor`` that hold the ``wanted`` largest eigenvalues,
    cut at gaps, as (from, to, eigenvalues by inertia)."""
    n = len(d)
    reach = float(np.abs(d).max() + 2 * np.abs(e).max(initial=0.0)) * (1 + 1e-9) + float(np.finfo("f8").tiny)
    lo, hi = floor, reach
    target = n - wanted  # eigenvalues that need not be found
    if int(inertia(d, e, np.array([floor]))[0]) < target:
        for _ in range(200):
            mid = _gap(d, e, lo, hi)
            if int(inertia(d, e, np.array([mid]))[0]) <= target:
                lo = mid
            else:
                hi = mid
            if int(inertia(d, e, np.array([lo]))[0]) == target or hi - lo <= 1e-13 * reach:
                break
    todo, out = [(lo, reach)], []
    while todo:
        a, b = todo.pop()
        low, high = inertia(d, e, np.array([a, b])).tolist()
        if high == low:
            continue
        if high - low <= PER_INTERVAL or b - a <= 1e-9 * reach:
            out.append((a, b, high - low))
            continue
        mid = _gap(d, e, a, b)
        todo += [(a, mid), (mid, b)]
    return sorted(out)


def filtered(v: np.ndarray, q: np.ndarray, lo: float, hi: float, nodes: int = NODES) -> np.ndarray:
    """The contour integral (1 / 2 pi i) of (z - v)^-1 q around [lo, hi]: it
    keeps what of ``q`` lies in the eigenspaces of the interval."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    out = np.zeros_like(q)
    eye = np.eye(len(v))
    for theta, weight in zip(np.pi / 2 * (x + 1), w):
        turn = np.exp(1j * theta)
        solved = np.linalg.solve((centre + radius * turn) * eye - v, q.astype(complex))
        out += weight / 2 * (radius * turn * solved).real  # the lower half is the conjugate
    return out


def feast(v: np.ndarray, lo: float, hi: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in [lo, hi), falling. Raises if
    fewer or more are found than the inertia counts say."""
    n = len(v)
    block = min(n, 2 * count + 4)
    scale = float(np.abs(v).max()) * n
    while True:
        q = np.random.default_rng(seed).standard_normal((n, block))
        best = None
        for _ in range(ROUNDS):
            q, _ = np.linalg.qr(filtered(v, q, lo, hi))
            e, s = np.linalg.eigh(q.T @ v @ q)
            q = q @ s
            inside = (e >= lo) & (e < hi)
            if inside.sum() != count:
                continue
            values, vectors = e[inside][::-1], q[:, inside][:, ::-1]
            off = float(np.abs(v @ vectors - vectors * values).max(initial=0))
            if best is not None and off >= best[0] / 2:  # no longer improving
                break
            best = (off, values, vectors)
            if off <= RESIDUAL * scale:
                break
        if best is not None:
            return best[1], best[2]
        if block == n:
            raise ArithmeticError(f"inertia counts {count} eigenvalues in [{lo}, {hi}), the contour gave {int(inside.sum())}")
        block = min(n, 2 * block)


def components(spark, v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (above rounding) of the symmetric
    ``v`` and their unit vectors as columns; each interval of the spectrum is
    worked on by a task."""
    n = len(v)
    scale = float(np.trace(v))
    if not n or scale <= 0:
        return np.zeros(0), np.zeros((n, 0))
    d, e = tridiagonal(v)
    parts = intervals(d, e, min(wanted, n), scale * n * 2.0**-50)
    if not parts:
        return np.zeros(0), np.zeros((n, 0))
    sent = v.tobytes()  # dims * dims doubles

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = np.frombuffer(sent).reshape(n, n)
        for frame in frames:
            for lo, hi, count in zip(frame["lo"], frame["hi"], frame["count"]):
                values, vectors = feast(matrix, lo, hi, int(count))
                yield pd.DataFrame({"e": values, "u": list(vectors.T)})

    table = spark.createDataFrame(parts, "lo double, hi double, count int").repartitionByRange(len(parts), "lo")
    found = table.mapInPandas(run, "e double, u array<double>").collect()  # the components
    if len(found) != sum(c for _, _, c in parts):
        raise ArithmeticError("an interval gave fewer eigenpairs than its inertia count")
    q, _ = np.linalg.qr(np.array([r[1] for r in sorted(found, key=lambda r: -r[0])]).T)
    values, s = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], (q @ s)[:, order]


# -- whitening ------------------------------------------------------------


@dataclass
class Fit:
    """``n`` vectors with sums ``sums`` of their entries less ``SHIFT``;
    ``values`` and unit ``vectors`` (columns) of their covariance."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows. The mean is taken off as an
        integer and a remainder, so nothing cancels."""
        whole = np.array([s // self.n for s in self.sums], "f8")
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return ((y - whole) - rest) @ self.vectors / np.sqrt(self.values)


def vector_size(vectors: DataFrame, column: str = "embedding") -> int:
    """The length that most vectors have (of ties the largest); 0 without vectors."""
    sizes = vectors.groupBy(F.size(column).alias("n")).count().filter("n > 0")
    top = sizes.orderBy(F.col("count").desc(), F.col("n").desc()).limit(1).collect()
    return int(top[0][0]) if top else 0


def fit(vectors: DataFrame, wanted: int = COMPONENTS, column: str = "embedding", dims: int | None = None) -> Fit:
    """Fit on every vector of the table that is whole and finite."""
    only = vectors.select(column)
    dims = dims if dims is not None else vector_size(vectors, column)
    n, sums = _sums(only, dims, None) if dims else (0, [])
    if not n:
        return Fit(0, sums, 0.0, np.zeros(0), np.zeros((dims, 0)))
    centre = [s // n for s in sums]
    _, products = _sums(only, dims, centre)
    rest = [s - n * c for s, c in zip(sums, centre)]  # sums of the centred entries, 0 <= rest < n
    exact = [[n * products[i * dims + j] - rest[i] * rest[j] for j in range(dims)] for i in range(dims)]
    v = np.array([[x / (n * n) for x in row] for row in exact])  # one rounding per entry
    values, u = components(vectors.sparkSession, v, wanted)
    return Fit(n, sums, float(sum(exact[i][i] for i in range(dims)) / (n * n)), values, u)


def identity_error(vectors: DataFrame, model: Fit, column: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    k, dims = len(model.values), len(model.sums)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, y = _entries(batch.column(0), dims)
            w = model.project(y)  # centred: their mean is 0
            total += w.sum(axis=0)
            products += w.T @ w
        flat = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["at", "v"])

    rows = vectors.select(column).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v")).collect()
    flat = np.zeros(k + k * k)
    for at, value in rows:
        flat[at] = value
    mean = flat[:k] / model.n
    return float(np.abs(flat[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, wanted: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per remaining vector and component.

    Left out are vectors that are null, empty, of another length than most,
    or that hold null, non-finite entries or entries of 2^46 and more.
    Repeated rows count as often as they occur; other columns are left out; a
    null id is kept as it is. Components whose eigenvalue is not above
    rounding (constant columns, fewer vectors than components) are not
    returned, so a table of equal vectors, or an empty one, gives no rows.
    Equal eigenvalues have no single basis: theirs is one of them, the same
    for all rows. ``deviation`` is null where it does not fit a long.
    """
    model = fit(vectors, wanted, column)
    dims, k, n = len(model.sums), len(model.values), model.n
    error = identity_error(vectors, model, column)
    explained = model.values / model.trace if k else model.values
    sums, id_type = model.sums, vectors.select(key).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows if k else 0, 2000):
                part = batch.slice(lo, 2000)
                rows, y = _entries(part.column(1), dims)
                if not len(rows):
                    continue
                most = n * int(np.abs(y).max()) + max(abs(s) for s in sums)
                if dims * most * most < 2**63:
                    off = n * y.astype("i8") - np.array(sums, "i8")
                    deviation = (off * off).sum(axis=1).tolist()
                else:
                    off = [[n * int(a) - s for a, s in zip(row, sums)] for row in y]
                    deviation = [d if (d := sum(a * a for a in row)) < 2**63 else None for row in off]
                m = len(rows)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), m)),
                        pa.array(np.full(m * k, n, "i8")),
                        pa.array(deviation, pa.int64()).take(each),
                        pa.array(model.project(y).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = f"{key} {id_type.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.select(key, column).mapInArrow(run, schema)
