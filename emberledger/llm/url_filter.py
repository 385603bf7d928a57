"""URL filters: rules on host and path, then a cascade of Bloom filters.

The cascade decides whether a host is listed, exactly, for every host of the
corpus. Level 1 encodes the listed hosts; level 2 the unlisted hosts of the
corpus that level 1 lets through; level 3 the listed ones that level 2 lets
through, and so on until a level lets nothing wrong through. Testing a host
walks the levels; no list of hosts is joined.

Hosts are dealt into shards by hash, each with a cascade of its own built in
one task from a bounded number of distinct hosts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import LOWER, UPPER, cut

#: (host, path, verdict): the longest that fits wins.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Site names whose hosts are listed.
LISTED = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: Distinct hosts per shard, about; bytes of cascades that are broadcast at once.
SHARD_KEYS = 200_000
BROADCAST_BYTES = 32 << 20


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.char_length(rest) + 4, F.char_length(url))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return F.when(url.contains("://"), F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.char_length(rest) + 4, F.char_length(url))
    return F.when(url.contains("://"), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule (``rule``, ``verdict``) that fits, else null. A rule
    fits its host and all subdomains where the path begins with the rule's."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# -- cascade --------------------------------------------------------------


def _places(h: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """Bit numbers of keys (two 64-bit hashes each) in a level."""
    with np.errstate(over="ignore"):
        a = h[:, 0] + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        b = (h[:, 1] ^ np.uint64(level * 0x51ED2701)) | np.uint64(1)
        x = a[:, None] + np.arange(1, k + 1, dtype="u8")[None, :] * b[:, None]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) % np.uint64(bits)


def _passes(level: tuple[int, int, bytes], n: int, h: np.ndarray) -> np.ndarray:
    bits, k, data = level
    at = _places(h, n, bits, k)
    filled = np.frombuffer(data, "u1")
    return ((filled[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("u1")) & 1).all(axis=1)


def build_cascade(keys: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Levels (bits, hashes, data) that tell listed from other keys without error."""
    inside, outside, levels = keys[listed], keys[~listed], []
    while len(inside):
        # the first level lets through about as many as it encodes, later ones half
        rate = min(0.5, len(inside) / max(1, len(outside)) / 2) if not levels else 0.5
        bits = max(8, int(np.ceil(len(inside) * 1.4427 * np.log2(1 / rate))))
        k = max(1, round(np.log2(1 / rate)))
        data = np.zeros((bits + 7) // 8, "u1")
        at = _places(inside, len(levels), bits, k).ravel()
        np.bitwise_or.at(data, (at >> np.uint64(3)).astype("i8"), np.left_shift(1, (at & np.uint64(7)).astype("u1")).astype("u1"))
        levels.append((bits, k, data.tobytes()))
        wrong = outside[_passes(levels[-1], len(levels) - 1, outside)] if len(outside) else outside
        inside, outside = wrong, inside
        if len(levels) > 200:
            raise ValueError("two keys have equal hashes")
    return levels


def test_cascade(levels: list[tuple[int, int, bytes]], h: np.ndarray) -> np.ndarray:
    """Whether keys are listed: a key is, if it passes an odd number of levels in a row."""
    alive, depth = np.ones(len(h), bool), np.zeros(len(h), "i8")
    for n, level in enumerate(levels):
        on = np.flatnonzero(alive)
        if not len(on):
            break
        ok = _passes(level, n, h[on])
        depth[on[ok]] += 1
        alive[on[~ok]] = False
    return depth % 2 == 1


def hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(5), F.col(key)).alias("h2")]


def cascades(keys: DataFrame, key: str, listed: Column, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """A cascade per shard of the complete key universe: ``shard``, ``shards``
    (how many there are), ``levels``. ``keys`` may repeat keys."""
    distinct = cut(keys.select(key).distinct().select(*hashes(key), listed.alias("listed")))
    shards = max(1, -(-distinct.count() // shard_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf[["h1", "h2"]].to_numpy("i8").view("u8")
        levels = build_cascade(h, pdf["listed"].to_numpy(bool))
        rows = [{"bits": b, "k": k, "data": d} for b, k, d in levels]
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "shards": [shards], "levels": [rows]})

    return cut(
        distinct.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, shards int, levels array<struct<bits:long,k:int,data:binary>>")
    )


def with_listed(df: DataFrame, key: str, built: DataFrame, out: str = "listed", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a boolean column: whether its key is listed.

    Cascades go to the tasks in groups of at most ``limit`` bytes (one shard
    is bounded by its number of keys); with several groups, each tests the
    rows of its shards, and the parts are put together.
    """
    spark = df.sparkSession
    size = F.aggregate("levels", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["data"]) + 64)
    groups: list[list[int]] = [[]]
    held = 0
    sizes = sorted(built.select("shard", size.alias("bytes"), "shards").collect())
    for shard, bytes_, _ in sizes:
        if groups[-1] and held + bytes_ > limit:
            groups.append([])
            held = 0
        groups[-1].append(shard)
        held += bytes_
    shards = sizes[0][2] if sizes else 1
    hashed = df.select("*", F.struct(*hashes(key)).alias("_h"))
    shard = F.pmod(F.col("_h.h1"), F.lit(shards)).cast("int")
    out_schema = df.select("*", F.lit(True).alias(out)).schema

    def tested(part: DataFrame, group: list[int]) -> DataFrame:
        rows = built.filter(F.col("shard").isin(group)).select("shard", "levels").collect()
        sent = spark.sparkContext.broadcast({r[0]: [(x["bits"], x["k"], bytes(x["data"])) for x in r[1]] for r in rows})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_shard = sent.value
            for batch in batches:
                h = batch.column(batch.schema.get_field_index("_h"))
                pairs = np.stack([h.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1).astype("i8").view("u8")
                of = np.mod(pairs[:, 0].view("i8"), shards)
                found = np.zeros(len(pairs), bool)
                for s in np.unique(of):
                    on = np.flatnonzero(of == s)
                    found[on] = test_cascade(by_shard.get(int(s), []), pairs[on])
                kept = [c for c, n in zip(batch.columns, batch.schema.names) if n != "_h"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=out_schema.names)

        return part.mapInArrow(run, out_schema)

    if len(groups) == 1:
        return tested(hashed, groups[0])
    parts = [tested(hashed.filter(shard.isin(g)), g) for g in groups]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def site_listed(host: Column, names: Sequence[str] = LISTED) -> Column:
    """Whether one of the host's labels is a listed site name."""
    return F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, names)))


def judge(pages: DataFrame, rules=RULES, listed=LISTED, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Per page ``page_id``, ``host``, ``path``, ``rule`` and ``verdict``.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed (the empty host is not listed). Repeated rows are
    judged alike; other columns are left out.
    """
    url = F.col("url")
    parts = pages.select(
        "page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path")
    )
    built = cascades(parts, "host", site_listed(F.col("host"), listed), shard_keys)
    tested = with_listed(parts, "host", built)
    fit = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return tested.withColumn("_fit", fit).select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"), F.coalesce(F.col("_fit.verdict"), own).alias("verdict")
    )
