"""Relational building blocks shared by the domain operators.

* ``fits_broadcast`` -- whether a lookup side may be broadcast, decided from
  known rows or file sizes, without a job.
* ``hot_key_join`` -- the same where the lookup is too large to broadcast and
  a few keys hold most facts.
* ``lookup_join`` -- fact-to-dimension join with renamed keys (N16) and
  dplyr-style null-safe matching (N3/J6).
* ``fan_out`` -- one row per label variant via ``explode`` (one scan
  instead of a self-union).
* ``to_long`` -- wide-to-long that keeps null cells (N12).
* ``bind`` -- union by name, filling missing columns with nulls (N14).
"""

from __future__ import annotations

import weakref
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session confs bounding what a lookup join may broadcast: rows, and bytes
# estimated from the schema (strings counted at STRING_BYTES on average).
MAX_ROWS_CONF = "emberledger.broadcast.maxRows"
MAX_BYTES_CONF = "emberledger.broadcast.maxBytes"
DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 256 * 1024 * 1024
STRING_BYTES = 32

# File sizes are compressed; in memory a table may be this much larger.
COMPRESSION = 8

_known_rows: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def row_bytes(schema: T.StructType) -> int:
    """Estimated in-memory bytes of one row of ``schema``."""
    size = 8
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            size += 8 + STRING_BYTES
        elif isinstance(t, (T.IntegerType, T.DateType, T.FloatType)):
            size += 4
        elif isinstance(t, (T.BooleanType, T.ByteType, T.ShortType)):
            size += 2
        elif isinstance(t, T.DecimalType) and t.precision > 18:
            size += 16
        else:
            size += 8
    return size


def mark_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Record that ``df`` has at most ``rows`` rows (known by construction)."""
    _known_rows[df] = rows
    return df


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to broadcast, without running a job.

    Either its rows are known by construction (``mark_bounded``), or the size
    statistics of its plan -- for a table, the sizes of the files it lists
    now -- times ``COMPRESSION`` stay within the session's limits.  Sizes
    are taken anew for every DataFrame, so a table that has grown is seen.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))
    width = row_bytes(df.schema)
    limit = min(int(conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES))), rows * width)
    known = _known_rows.get(df)
    if known is not None:
        return known * width <= limit
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size * COMPRESSION <= limit


def carry_bound(src: DataFrame, derived: DataFrame, factor: int = 1) -> DataFrame:
    """``derived`` has at most ``factor`` times the rows of ``src`` (e.g. a
    projection or filter of it); keep a known bound of ``src``."""
    rows = _known_rows.get(src)
    if rows is not None:
        _known_rows[derived] = rows * factor
    return derived


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    sized_as: DataFrame | None = None,
) -> DataFrame:
    """Join a (possibly huge) fact table to a lookup.

    ``on`` is a list of shared key names or a mapping ``fact_key ->
    dim_key``; the output keeps the fact-side names only (N16).  With
    ``null_safe`` a null key matches a null key, as dplyr joins do.

    The lookup is broadcast when it is small (``fits_broadcast``); otherwise
    the planner decides -- a sort-merge join, whose hot keys AQE splits and
    which it turns into a broadcast join if the side measures small.
    ``sized_as`` names a DataFrame that ``dim`` has no more rows than, where
    the statistics of ``dim`` itself say little (a join, gathered arrays).
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    tmp = {d: f"__key_{i}" for i, (_, d) in enumerate(pairs)}
    right = dim.withColumnsRenamed(tmp)
    if fits_broadcast(sized_as if sized_as is not None else dim):
        right = F.broadcast(right)
    cond: list[Column] = []
    for f, d in pairs:
        lc, rc = facts[f], right[tmp[d]]
        cond.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    out = facts.join(right, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return carry_bound(facts, out)
    out = out.drop(*tmp.values())
    dim_rows = _known_rows.get(dim)
    if dim_rows is not None:
        carry_bound(facts, out, max(dim_rows, 1))  # each fact row meets <= dim_rows rows
    return out


#: Hot keys that ``hot_key_join`` treats apart, rows of the lookup that such a key may have, and keys its sketch tracks.
HOT_KEYS, ROWS_PER_HOT_KEY, TRACKED_KEYS = 256, 64, 10_000


def hot_key_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """``lookup_join`` to a lookup above the broadcast limit, where a few
    keys may hold most of the facts -- also within a single map output, which
    adaptive execution cannot split.

    One pass over the facts' keys feeds a heavy-hitter sketch in every task
    (``approx_top_k``; partial sketches are merged). The facts of the
    ``hot_keys`` most frequent keys never shuffle: they meet a broadcast of
    those keys' few lookup rows. The others take the sort-merge join. What is
    broadcast is bounded by construction: ``hot_keys`` hashes, and at most
    ``ROWS_PER_HOT_KEY`` lookup rows for each -- a key with more is left to the
    sort-merge join. Rows are the same as those of ``lookup_join``, whatever
    the sketch finds. Nothing runs before the result is used.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: left or inner")
    pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
    if not null_safe:  # null keys match nothing: they need not move
        keyed = facts.where(" and ".join(f"`{f}` is not null" for f, _ in pairs))
    else:
        keyed = facts
    # both sides hash values of one type: that of the comparison
    types = [facts.select(f).union(dim.select(d)).schema[0].dataType for f, d in pairs]
    h, r = "__hash", "__hot"
    hash_of = lambda names: F.xxhash64(*[F.col(f"`{n}`").cast(t) for n, t in zip(names, types)])
    fact_hash, dim_hash = hash_of([f for f, _ in pairs]), hash_of([d for _, d in pairs])

    top = keyed.select(fact_hash.alias(h)).agg(F.expr(f"approx_top_k({h}, {hot_keys}, {max(TRACKED_KEYS, hot_keys)})").alias("top"))
    hot = top.select(F.explode("top").alias("top")).select(F.col("top.item").alias(h))
    hashed = dim.withColumn(h, dim_hash)
    sizes = hashed.select(h).join(F.broadcast(hot), h).groupBy(h).agg(F.count(F.lit(1)).alias("n"))
    wide = sizes.where(F.col("n") > ROWS_PER_HOT_KEY).select(h)
    chosen = hot.join(F.broadcast(wide), h, "left_anti").withColumn(r, F.lit(True))

    marked = facts.withColumn(h, fact_hash).join(F.broadcast(chosen), h, "left")
    some = hashed.join(F.broadcast(chosen), h, "left_semi").drop(h)
    split = [(F.col(r).isNotNull(), mark_bounded(some, hot_keys * ROWS_PER_HOT_KEY)), (F.col(r).isNull(), dim)]
    parts = [lookup_join(marked.where(which).drop(h, r), side, on, how, null_safe) for which, side in split]
    return parts[0].unionByName(parts[1])


def fan_out(df: DataFrame, column: str, suffixes: Sequence[str]) -> DataFrame:
    """One output row per suffix, ``column`` becoming ``column || suffix``.

    Equivalent to a union of relabelled copies (U2) but reads the input once.
    A null ``column`` stays null in every copy (N7).
    """
    variants = F.array(*[F.concat(F.col(column), F.lit(s)) for s in suffixes])
    return df.withColumn(column, F.explode(variants))


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None,
    names_to: str,
    values_to: str,
) -> DataFrame:
    """Wide to long, keeping null cells (N12). ``values=None`` means all
    non-id columns, in order (P7)."""
    cols = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), cols, names_to, values_to)


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Contiguous column range ``first:last`` of ``df``."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return cols[i : j + 1]


def bind(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing in one input is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def crossing(spark, schema: str, **domains: Sequence) -> DataFrame:
    """Sorted, de-duplicated product of literal value domains.

    The domains are parameters, not data. The product is built by exploding
    one array literal per domain, so it may have any size, and no cross join
    is planned.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    out = spark.range(1).select()
    size = 1
    for field, values in zip(fields, domains.values()):
        axis = sorted(set(values))
        size *= len(axis)
        literal = F.array(*[F.lit(v).cast(field.dataType) for v in axis]).cast(T.ArrayType(field.dataType))
        out = out.withColumn(field.name, F.explode(literal))
    return mark_bounded(out.orderBy(*[f.name for f in fields]), size)


def when_map(column: str | Column, mapping: Mapping, default: Column | None = None) -> Column:
    """``case_when`` over equality branches; no match gives ``default``
    (null when not given, N5)."""
    c = F.col(column) if isinstance(column, str) else column
    out = None
    for k, v in mapping.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = F.when(c == F.lit(k), val) if out is None else out.when(c == F.lit(k), val)
    if out is None:
        return default if default is not None else F.lit(None)
    return out.otherwise(default) if default is not None else out


def when_groups(column: str | Column, groups: Mapping, default: Column | None = None) -> Column:
    """``case_when`` over ``%in%`` branches: ``{label: [members...]}``."""
    c = F.col(column) if isinstance(column, str) else column
    out = None
    for label, members in groups.items():
        val = label if isinstance(label, Column) else F.lit(label)
        cond = c.isin(list(members))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    if out is None:
        return default if default is not None else F.lit(None)
    return out.otherwise(default) if default is not None else out
