"""Exact sums of doubles: against rational arithmetic, in any partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberledger.functions.semantics import exact_sum, limbs_value, na_mean, na_sum, sum_limbs, sum_or_zero, sum_outside

SCHEMA = "k string, v double"


def nearest(values):
    """The double nearest to the exact sum."""
    return float(sum((Fraction(v) for v in values), Fraction(0)))


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(8)
    out = {
        "cancel": [1e16, 1.0, -1e16, 0.1, -0.1, 2.0**-40],
        "tenths": [0.1] * 1000,
        "negative": [-(rng.random() ** 9) * 1e6 for _ in range(300)],
        "zero": [5.5, -5.5],
        "tie_up": [2.0**53, 1.0, 2.0**-60],
        "tie_even": [2.0**53, 1.0],
        "tie_odd": [2.0**53 + 2, 1.0],
        "small": [rng.random() * 1e-20 for _ in range(50)],
        "large": [rng.uniform(-1, 1) * 2.0**95 for _ in range(50)],
        "one": [math.pi],
    }
    for i in range(40):
        out[f"r{i}"] = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 20) for _ in range(rng.randint(1, 60))]
    return out


def frame(spark, groups, parts=3, seed=0):
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_nearest_double_in_any_order(spark, groups):
    want = {k: nearest(vs) for k, vs in groups.items()}
    for parts, seed in ((1, 1), (7, 2)):
        got = {r.k: r.s for r in frame(spark, groups, parts, seed).groupBy("k").agg(exact_sum("v").alias("s")).collect()}
        assert got == want


def test_partial_sums_merge(spark, groups):
    """Limbs of parts, added, are the limbs of the whole."""
    df = frame(spark, groups).withColumn("part", F.pmod(F.xxhash64("v"), F.lit(4)))
    names = [f"l{i}" for i in range(len(sum_limbs("v")))]
    state = df.groupBy("k", "part").agg(*[x.alias(n) for x, n in zip(sum_limbs("v"), names)], sum_outside("v").alias("o"))
    merged = state.groupBy("k").agg(*[F.sum(n).alias(n) for n in names], F.sum("o").alias("o"))
    got = {r.k: r.s for r in merged.select("k", limbs_value([F.col(n) for n in names], F.col("o")).alias("s")).collect()}
    assert got == {k: nearest(vs) for k, vs in groups.items()}


def test_null_rules(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", None), ("a", 0.2), ("b", None), ("c", 0.1), ("c", 0.7)], SCHEMA)
    got = {r.k: tuple(r)[1:] for r in df.groupBy("k").agg(
        na_sum("v", exact=True).alias("na"), sum_or_zero("v", exact=True).alias("z"), exact_sum("v").alias("s"), na_mean("v", exact=True).alias("m")).collect()}
    both = nearest([0.1, 0.2])
    assert got == {"a": (None, both, both, None), "b": (None, 0.0, None, None), "c": (nearest([0.1, 0.7]),) * 3 + (nearest([0.1, 0.7]) / 2,)}
    none = df.where("k = 'x'").agg(na_sum("v", exact=True).alias("na"), sum_or_zero("v", exact=True).alias("z"), na_mean("v", exact=True).alias("m"))
    assert tuple(none.first()) == (0.0, 0.0, None)


def test_over_a_window(spark, groups):
    w = Window.partitionBy("k")
    got = {(r.k, r.s) for r in frame(spark, groups).select("k", exact_sum("v", w).alias("s")).collect()}
    assert got == {(k, nearest(vs)) for k, vs in groups.items()}


def test_values_beyond_the_limbs(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("i", inf), ("i", 1.0), ("n", nan), ("n", 1.0), ("h", 1e300), ("h", 1.0), ("t", 1e-320)], SCHEMA)
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got["i"] == inf and math.isnan(got["n"]) and got["h"] == 1e300 and got["t"] == 0.0
