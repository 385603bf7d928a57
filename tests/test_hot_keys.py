"""Joins to lookups above the broadcast limit, with keys that hold most facts."""

import random

import pytest
from pyspark.sql import functions as F

from checks import rows
from emberledger.operators.relational import MAX_BYTES_CONF, ROWS_PER_HOT_KEY, hot_key_join, lookup_join


@pytest.fixture
def no_broadcast(spark):
    """Lookups of any size are above the limit, but for sides of few known rows."""
    keys = {MAX_BYTES_CONF: "2000000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nodes(plan):
    """All nodes of an executed plan, in its stages too."""
    yield plan
    name = plan.nodeName()
    inner = []
    if name == "AdaptiveSparkPlan":
        inner = [plan.executedPlan()]
    elif "QueryStage" in name:
        inner = [plan.plan()]
    children = plan.children()
    for child in [*inner, *(children.apply(i) for i in range(children.size()))]:
        yield from nodes(child)


def shuffled(df):
    """Rows written to each shuffle of the executed query."""
    out = []
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
    return out


def tables(spark, n=6000, lookup=3000):
    rng = random.Random(1)
    facts = [(7 if i % 3 == 0 else None if i % 10 == 1 else rng.randrange(lookup + 50), "k" if i % 3 == 0 else f"s{i % 2}", i) for i in range(n)]
    dim = [(i, s, f"{i}{s}") for i in range(lookup) for s in ("k", "s0")] + [(None, "s1", "none")]
    f = spark.createDataFrame(facts, "id int, s string, n int")
    d = spark.createDataFrame(dim, "did int, s string, name string").repartition(4)
    return f, d


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_the_lookup_join(spark, no_broadcast, how, null_safe):
    f, d = tables(spark)
    for on in ({"id": "did"}, {"id": "did", "s": "s"}):
        side = d if len(on) == 2 else d.where("s = 'k'").drop("s")
        want = rows(lookup_join(f, side, on, how, null_safe))
        for hot in (3, 256):
            got = hot_key_join(f, side, on, how, null_safe, hot_keys=hot)
            assert rows(got) == want and got.columns == lookup_join(f, side, on, how, null_safe).columns


def test_a_hot_key_in_one_map_output_is_not_shuffled(spark, no_broadcast):
    n = 30_000
    facts = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 20_000).alias("k"), "id").coalesce(1)
    dim = spark.range(25_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = lookup_join(facts, dim, ["k"], "left")
    apart = hot_key_join(facts, dim, ["k"], "left", hot_keys=8)
    assert rows(plain) == rows(apart)
    plain.write.format("noop").mode("overwrite").save()
    for df, most in ((plain, n), (apart, n * 2 // 3)):
        df.collect()
        assert max(x for x in shuffled(df) if x != 25_000) <= most
    assert max(x for x in shuffled(plain) if x != 25_000) == n
    joins = {x.nodeName() for x in nodes(apart._jdf.queryExecution().executedPlan()) if "Join" in x.nodeName()}
    assert "BroadcastHashJoin" in joins and joins & {"SortMergeJoin", "ShuffledHashJoin"}


def test_a_hot_key_with_many_lookup_rows_is_left_alone(spark, no_broadcast):
    many = ROWS_PER_HOT_KEY + 5
    facts = spark.range(50).select(F.lit(1).alias("k"), "id")
    dim = spark.range(many).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    got = hot_key_join(facts, dim, ["k"], "inner")
    assert got.count() == 50 * many


def test_types_that_differ_and_empty_sides(spark, no_broadcast):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, x string")
    dim = spark.createDataFrame([(1, "one")], "k long, name string")
    assert rows(hot_key_join(facts, dim, ["k"], "left"), "x", "name") == [("a", "one"), ("b", "one"), ("c", None)]
    assert hot_key_join(facts.where("k > 9"), dim, ["k"]).collect() == []
    assert rows(hot_key_join(facts, dim.where("k > 9"), ["k"]), "x", "name") == [("a", None), ("b", None), ("c", None)]
    with pytest.raises(ValueError):
        hot_key_join(facts, dim, ["k"], "full")
