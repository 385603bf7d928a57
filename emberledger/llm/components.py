"""Connected components over a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import Scope


def _via(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent, where it has one."""
    p = parents.select(F.col("id").alias("_id"), F.col("parent").alias("_parent"))
    return (
        df.join(p, F.col(column) == F.col("_id"), "left")
        .withColumn(column, F.coalesce("_parent", column))
        .drop("_id", "_parent")
    )


def components(links: DataFrame, scope: Scope) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in
    ``links`` (``u``, ``v``: not null) that is not its own component.

    Each round hooks every id to its smallest neighbour below it, shortens
    the chains by doubling, and replaces the links' ends by their roots;
    links inside a component disappear. An id with very many links is a hot
    key of shuffled joins between checkpointed tables only, which AQE splits,
    and of aggregations, which combine before the shuffle.
    """
    cut = scope.cut
    ordered = lambda df: df.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    edges = cut(ordered(links))
    done = None
    while not edges.isEmpty():
        parents = cut(edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("parent")))
        while True:
            jumped = cut(_via(parents.withColumn("old", F.col("parent")), "parent", parents))
            parents = jumped.select("id", "parent")
            if jumped.filter("old <> parent").isEmpty():
                break
        edges = cut(ordered(_via(_via(edges, "u", parents), "v", parents)))
        if done is None:
            done = parents
        else:
            moved = _via(done, "parent", parents)
            done = cut(moved.unionByName(parents.join(done.select("id"), "id", "left_anti")))
    if done is None:
        return links.select(F.col("u").alias("id"), F.col("v").alias("component")).limit(0)
    return done.select("id", F.col("parent").alias("component"))
