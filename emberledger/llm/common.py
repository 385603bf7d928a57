"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberledger.session import ensure_checkpoint_dir

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space as trim characters.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hash buckets that a group is split into before anything is ordered in it.
BUCKETS = 4096
#: Rows up to which a checkpointed side may be broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the cluster's checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's checkpoint folder, removed when the session ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


class Scope:
    """Intermediate tables of an iterative operator.

    Each is written as Parquet into the cluster's checkpoint folder and read
    back, so neither lineage nor anything Catalyst has inferred about earlier
    steps is carried along. ``close`` removes all but the given result.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, "step")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def inside(self, step, *args) -> DataFrame:
        """What ``step(*args, scope)`` returns, with a scope of its own: its
        steps are removed at once, its result belongs to this scope."""
        own = Scope(self.spark)
        result = own.close(step(*args, own))
        self.paths += own.paths
        return result

    def close(self, result: DataFrame) -> DataFrame:
        steps, self.paths = self.paths, []
        result = self.cut(result)
        for path in steps:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        return result


def lookup(df: DataFrame, side: DataFrame, on, how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a checkpointed ``side``: broadcast if its counted rows are at most
    ``max_rows``, else a shuffled join (whose hot keys AQE splits)."""
    small = side.count() <= max_rows  # one number per task
    return df.join(F.broadcast(side) if small else side, on, how)


def null_last(name: str) -> Column:
    """A string column as a non-null key that sorts by code point, null last."""
    c = F.col(name).cast("string")
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def per_process(key, make):
    """What ``make`` returns, made once in a worker process and kept for later tasks."""
    kept = sys.modules.setdefault("_emberledger_kept", types.ModuleType("_emberledger_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Return to the system what Arrow and the C library hold unused."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)


def let_go() -> None:
    """Drop what ``per_process`` kept for operators before this one, and give back unused memory."""
    sys.modules.pop("_emberledger_kept", None)
    give_back()


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows at once between the JVM and
    Python; frames that are run later do not."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    spread: Sequence[Column],
    weight: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Number the rows of each group from 0 without one task per group.

    Rows of a group are dealt into ``buckets`` by the hash of ``spread`` and
    ordered inside a bucket; a bucket's first number is the sum over the
    buckets before it. A group with a third of all rows is thus worked on by
    ``buckets`` windows; only the per-bucket sums of a group meet. Group
    columns must not be null. Adds ``_bucket``, ``_row`` (number in the
    bucket) and ``_at``: the sum of ``weight`` (1 by default) over the
    earlier rows of the group.
    """
    weight = F.lit(1).cast("long") if weight is None else weight.cast("long")
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")).withColumn("_w", weight)
    keys = [*group, "_bucket"]
    base = (
        rows.groupBy(*keys)
        .agg(F.sum("_w").alias("_sum"))
        .withColumn(
            "_base",
            F.coalesce(
                F.sum("_sum").over(
                    Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_sum")
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = F.coalesce(F.sum("_w").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("_row", F.row_number().over(inside))
        .withColumn("_before", before)
        .join(base, keys)
        .withColumn("_at", F.col("_base") + F.col("_before"))
        .drop("_base", "_before", "_w")
    )


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the first ``n_keys`` columns
    (integers, not null). Holds one run and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:]):
            key = tuple(keys[:, lo])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def pack(*columns: np.ndarray) -> bytes:
    """Arrays, or bytes, as one compressed buffer."""
    parts = [c if isinstance(c, bytes) else np.ascontiguousarray(c).tobytes() for c in columns]
    head = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
    raw = head + b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(body: bytes, *kinds: str) -> list:
    """What ``pack`` was given: arrays of the given types, or "bytes"."""
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)
    sizes = np.frombuffer(raw, "<i8", 1 + len(kinds))[1:]
    ends = 8 * (1 + len(kinds)) + np.cumsum(sizes)
    return [raw[e - n : e] if kind == "bytes" else np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, e - n)
            for kind, n, e in zip(kinds, sizes.tolist(), ends.tolist())]


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Consecutive rows that agree in the first column, as tuples."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != key:
                yield key, held
                held = []
            key = row[0]
            held.append(row)
    if held:
        yield key, held


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member number of the component of each of ``n`` members under links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    return label
