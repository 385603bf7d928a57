"""Sharding by histogram sort.

Rows are ordered by the hash of their text, then of their id. The shard
boundaries are found by counting the exact bytes below candidate boundaries
over all partitions: each round splits the bins that hold a boundary into
``2**DIGIT`` finer ones and counts again, until every bin that holds one is
within the tolerance or a single key. Then rows go to their shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import cut, ranked

#: Bits by which a round refines a bin.
DIGIT = 12
#: Of a shard's even share: how far a boundary may be off.
TOLERANCE = 0.001


def _digits(hi: str, lo: str) -> list[Column]:
    """The key (two hashes) as digits, the first the most significant."""
    out = []
    for c in (hi, lo):
        for shift in (52, 40, 28, 16, 4):
            out.append(F.shiftrightunsigned(F.col(c), shift).bitwiseAND(F.lit((1 << DIGIT) - 1)))
        out.append(F.col(c).bitwiseAND(F.lit(15)))
    return out


def _digits_of(value: int) -> tuple[int, ...]:
    """The digits of one hash, as ``_digits`` gives them."""
    return tuple((value >> shift) & ((1 << DIGIT) - 1) for shift in (52, 40, 28, 16, 4)) + (value & 15,)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """For each inner boundary, the digits of the first key that lies above
    it; a shorter list of digits stands for all keys that begin with it.

    ``rows`` has ``_h``, ``_d`` (the key) and ``size``. A round reads at most
    ``(shards - 1) * 2**DIGIT`` sums, whatever the number of rows. A group of
    equal texts is split by the second hash only where it is larger than the
    tolerance.
    """
    digits = _digits("_h", "_d")
    total = rows.agg(F.sum("size")).first()[0] or 0
    close = tolerance * total / shards
    #: boundary -> (digits that are settled, bytes below all keys that begin with them)
    open_, found = {j: ((), 0) for j in range(1, shards)}, {}
    while open_ and total:
        bins = sorted({p for p, _ in open_.values()})
        probe = reduce(
            lambda rest, i: F.when(
                reduce(lambda a, b: a & b, [d == v for d, v in zip(digits, bins[i])], F.lit(True)),
                F.struct(F.lit(i).alias("bin"), digits[len(bins[i])].alias("digit")),
            ).otherwise(rest),
            range(len(bins)),
            F.lit(None),
        )
        counted = (
            rows.select(probe.alias("probe"), "size", "_h", "_d")
            .filter("probe is not null")
            .groupBy("probe.bin", "probe.digit")
            .agg(F.sum("size").alias("bytes"), *[f(c).alias(f"{f.__name__}{c}") for f in (F.min, F.max) for c in ("_h", "_d")])
            .collect()
        )
        sums = {i: sorted((r for r in counted if r["bin"] == i), key=lambda r: r["digit"]) for i in range(len(bins))}
        still = {}
        for j, (prefix, below) in open_.items():
            goal = j * total / shards
            for r in sums[bins.index(prefix)]:
                if below + r["bytes"] >= goal:
                    break
                below += r["bytes"]
            at, size = (*prefix, r["digit"]), r["bytes"]
            one_text = r["min_h"] == r["max_h"]
            if size <= close or one_text and r["min_d"] == r["max_d"] or len(at) == len(digits):
                # the boundary goes to the nearer edge of the bin
                found[j] = at if goal - below <= below + size - goal else (*at[:-1], at[-1] + 1)
            elif one_text and len(at) < len(digits) // 2:
                still[j] = (_digits_of(r["min_h"]), below)
            else:
                still[j] = (at, below)
        open_ = still
    return [found[j] for j in sorted(found)]


def shard_of(bounds: list[tuple[int, ...]]) -> Column:
    """The number of boundaries that are not above the row's key."""
    digits = _digits("_h", "_d")

    def reached(bound: tuple[int, ...]) -> Column:
        out = F.lit(True)
        for d, v in reversed(list(zip(digits, bound))):
            out = (d > v) | ((d == v) & out)
        return out

    return reduce(lambda a, b: a + b, [reached(b).cast("int") for b in bounds], F.lit(0))


def shard_rows(docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE) -> DataFrame:
    """Deal documents (``doc_id``, ``text``) into shards of near equal bytes.

    Returns ``doc_id``, ``size`` (UTF-8 bytes plus 1; a null text has none),
    ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in its shard).
    Equal texts lie next to each other in the order, so a group of copies
    shares a shard unless a boundary has to cut it. Rows that agree in id and
    text are one key: they share a shard and come in either order. An empty table gives no rows; with fewer
    rows than shards some shards stay empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("_h"),
            F.xxhash64(F.lit(1), F.col("doc_id")).alias("_d"),
        )
    )
    bounds = splitters(rows, shards, tolerance)
    dealt = rows.withColumn("shard", shard_of(bounds).cast("int"))
    out = ranked(dealt, ["shard"], [F.col("_h"), F.col("_d"), F.col("doc_id")], [F.col("_d")])
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("_at").cast("long").alias("slot"))
