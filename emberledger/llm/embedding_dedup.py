"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector is rotated at random and kept as the signs of its coordinates
(one bit each) with a correction factor: the inner product of the vector and
its code. For a query q, <code, q> / factor is an unbiased estimate of the
cosine. The angles vector-code and vector-query add up to at least the angle
code-query, so the factor alone bounds how far the estimate of a pair at the
threshold can lie below it: a pair under that bound is surely no link and is
rejected, every other pair is recomputed exactly in double precision.

The bound decides over every pair of a label's vectors: they are dealt into
blocks of at most ``BLOCK`` vectors and ``BLOCK_BYTES``, and every two blocks
meet once. No link is lost at any size; a label of n vectors costs n² / 2 code
comparisons, spread over the pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import Scope, cut, lookup, per_process, roots, runs
from emberledger.llm.components import components

THRESHOLD = 0.93
#: Most vectors of a block, most bytes of its vectors, and vectors that are compared with a block at a time.
BLOCK, BLOCK_BYTES, TARGET = 8192, 1 << 24, 256
#: Standard errors that nearly every estimate keeps; pairs are rejected by an exact bound, not by these.
SIGMAS = 4.0
SEED = 9


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same in every task."""

    def make() -> np.ndarray:
        q, r = np.linalg.qr(np.random.default_rng([seed, dim, 0]).standard_normal((dim, dim)))
        return q * np.sign(np.diag(r))

    return per_process(("rotation", dim, seed), make)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs) and correction factors of unit vectors."""
    y = x @ rotation(x.shape[1]).T
    return np.packbits(y > 0, axis=1), np.abs(y).sum(axis=1) / math.sqrt(x.shape[1])


def estimate(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries by codes) and the standard error per code."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype("f4") * 2 - 1
    rotated = (queries @ rotation(dim).T).astype("f4")
    f = np.maximum(factors, 1e-6)
    error = np.sqrt(np.maximum(1 - f**2, 0) / f**2 / max(1, dim - 1))
    return (rotated @ signs.T) / (math.sqrt(dim) * f)[None, :], error


def floors(factors: np.ndarray, dim: int, threshold: float) -> np.ndarray:
    """Per code the least estimate that a pair at ``threshold`` or above can
    have (by the sum of angles), less the rounding of single precision."""
    f = np.maximum(factors, 1e-6)
    least = f * threshold - np.sqrt(np.maximum(1 - f**2, 0) * (1 - threshold**2))
    return (np.where(f > -threshold, least, -1.0) - 1e-5 - dim * 2.0**-22) / f


def links_in(
    x: np.ndarray, codes: np.ndarray, factors: np.ndarray, side: np.ndarray, cross: bool, threshold: float = THRESHOLD
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (i, j) of one block, or of two blocks against each other
    (``cross``), some at a time."""
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if cross else left
    least = floors(factors, x.shape[1], threshold).astype("f4")
    for lo in range(0, len(left), TARGET):
        rows = left[lo : lo + TARGET]
        others = right if cross else right[lo:]
        near, _ = estimate(codes[others], factors[others], x[rows])
        i, j = np.nonzero(near >= least[others][None, :])
        a, b = rows[i], others[j]
        if not cross:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 1 << 16):
            s, t = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            ok = np.einsum("ij,ij->i", x[s], x[t]) >= threshold
            yield s[ok], t[ok]


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Usable rows as ``row``, ``vec_id``, ``label``, ``dim`` and ``unit``
    (bytes of the unit vector in double precision)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, units = [], [], []
            for i, v in enumerate(batch.column(3).to_pylist()):
                if v and None not in v:
                    x = np.array(v, "f8")
                    if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
                        x = x / top
                        keep.append(i)
                        dims.append(len(x))
                        units.append((x / math.sqrt(x @ x)).tobytes())
            kept = batch.take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[:3], pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                names=["row", "vec_id", "label", "dim", "unit"],
            )

    rows = vectors.filter("label is not null and vec_id is not null and embedding is not null")
    rows = rows.select("row", "vec_id", F.col("label").cast("long").alias("label"), "embedding")
    return rows.mapInArrow(run, "row long, vec_id long, label long, dim int, unit binary")


def block_links(units: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """For every vector with links in a pair of blocks: ``row``, ``vec_id``,
    ``links`` (pairs there; a pair is in one pair of blocks) and ``root``
    (smallest vec_id it is linked with there, over any number of links). A row
    per vector and pair of blocks at most."""
    spark = units.sparkSession

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                codes, factors = encode(np.stack([np.frombuffer(u.as_buffer(), "f8") for u in part.column(4)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(3), part.column(0), part.column(1), part.column(4), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors)],
                    names=["label", "dim", "row", "vec_id", "unit", "code", "factor"],
                )

    key = ["label", "dim"]
    placed = units.mapInArrow(place, "label long, dim int, row long, vec_id long, unit binary, code binary, factor double")
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8))))
    counts = units.groupBy(*key).count().filter("count > 1")
    counts = cut(counts.withColumn("parts", F.ceil(F.col("count") / most).cast("int")).drop("count"))
    rows = lookup(placed, counts, key, "inner")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("a", F.least("part", "other")).withColumn("b", F.greatest("part", "other"))
    rows = rows.withColumn("side", (F.col("part") == F.col("b")).cast("int") * (F.col("a") != F.col("b")).cast("int"))
    blocks = [*key, "a", "b"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, len(blocks)):
            ids = run.column("vec_id").to_numpy()
            x = np.stack([np.frombuffer(u.as_buffer(), "f8") for u in run.column("unit").combine_chunks()])
            codes = np.stack([np.frombuffer(u.as_buffer(), "u1") for u in run.column("code").combine_chunks()])
            order = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), "i8")
            rank[order] = np.arange(len(ids))
            n, root = np.zeros(len(ids), "i8"), np.arange(len(ids))
            cross = run.column("a")[0] != run.column("b")[0]
            for i, j in links_in(x, codes, run.column("factor").to_numpy(), run.column("side").to_numpy(), cross, threshold):
                n += np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
                root = roots(len(ids), root[rank[i]], root[rank[j]])[root]
            on = np.flatnonzero(n)
            if not len(on):
                continue
            root = ids[order][root[rank]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(run.column("row").to_numpy()[on]), pa.array(ids[on]), pa.array(n[on]), pa.array(root[on])],
                names=["row", "vec_id", "links", "root"],
            )

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*blocks, "row", "vec_id", "unit", "code", "factor", "side")
    return dealt.repartition(n, *blocks).sortWithinPartitions(*blocks).mapInArrow(search, "row long, vec_id long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors`` (``vec_id``, ``embedding``, ``label``): ``vec_id``,
    ``n_links``, ``component_id``, ``kept``.

    Rows link when their labels are equal and their cosine is at least
    ``threshold``; null labels or ids, and vectors that are null, empty, zero
    or hold a null or non-finite component, link with nothing, nor do vectors
    of different lengths. A repeated row is a vector of its own (it links with
    its copy). All pairs are found, and every one is exact.
    """
    rows = cut(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").withColumn("row", F.monotonically_increasing_id()))
    found = cut(block_links(cut(unit_vectors(rows)), threshold, block))
    scope = Scope(vectors.sparkSession)
    groups = scope.close(components(found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")), scope))
    links = cut(found.groupBy("row").agg(F.sum("links").cast("long").alias("n_links")))
    out = rows.select("row", "vec_id").join(links, "row", "left").join(groups, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
