"""Connected groups of rows that share a bucket and pass a check, without all pairs of a bucket.

DataFrame operations alone. Links, groups and buckets stay distributed; the driver sees counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.shared import freeing, written


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``a, b`` that is not the smallest of its component.

    Each node hooks to its smallest neighbour below it, chains are halved until they are flat, and edges
    are drawn anew between what is left, until none is. Each is a grouping that combines before
    the shuffle or a join that Spark splits when a node has many links.
    """
    with freeing() as keep:
        return keep(_components(edges))


def _components(edges: DataFrame) -> DataFrame:
    edges = _tidy(edges)
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        parent = written(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")), "parents")
        while True:
            above = parent.select(F.col("id").alias("component"), F.col("component").alias("above"))
            jumped = written(
                parent.join(above, "component", "left").select(
                    "id",
                    F.coalesce("above", "component").alias("component"),
                    F.col("above").isNotNull().alias("moved"),
                ),
                "parents",
            )
            parent = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        levels.append(parent)
        edges = _tidy(_relabel(_relabel(edges, "a", parent), "b", parent))
    if not levels:
        return written(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), "components")
    labels = levels[0]
    for level in levels[1:]:
        up = level.select(F.col("id").alias("component"), F.col("component").alias("up"))
        labels = (
            labels.join(up, "component", "left")
            .select("id", F.coalesce("up", "component").alias("component"))
            .unionByName(level)
        )
    return written(labels, "components")


def _tidy(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return written(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")


def _relabel(edges: DataFrame, end: str, parent: DataFrame) -> DataFrame:
    new = parent.select(F.col("id").alias(end), "component")
    other = "b" if end == "a" else "a"
    return edges.join(new, end, "left").select(F.coalesce("component", end).alias(end), other)


def link_buckets(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    cross: Callable[[DataFrame], DataFrame],
    gathered: Callable[[], None] = lambda: None,
    mark: str = "false",
) -> DataFrame:
    """``components`` of the rows of ``key, id``, joined by pairs in one bucket that ``verify`` lets pass.

    First, every bucket's members are checked against its smallest one; ``verify`` gets distinct ``a > b``, and in
    ``marked`` whether the SQL condition ``mark`` holds for the ``key`` of a bucket that they share. Buckets
    whose members are then in one group are done: no further link could change it, so copies are never
    paired with each other. For the others, ``cross`` gets the members as ``key, id, component`` and returns links
    ``a, b`` that pass the same check, enough to join all members of a bucket that links can join. ``gathered`` is
    called when ``buckets`` is not read any more.
    """
    with freeing() as keep:
        return keep(_linked(buckets, verify, cross, gathered, mark))


def _linked(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    cross: Callable[[DataFrame], DataFrame],
    gathered: Callable[[], None] = lambda: None,
    mark: str = "false",
) -> DataFrame:
    shared = (
        buckets.groupBy("key")
        .agg(F.min("id").alias("hub"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    members = written(buckets.join(shared, "key").select("key", "id", "hub"), "members")
    gathered()
    pairs = members.where("id > hub").groupBy(F.col("id").alias("a"), F.col("hub").alias("b"))
    with freeing() as keep:
        tested = written(pairs.agg(F.max(F.expr(mark)).alias("marked")), "pairs")
        links = keep(written(verify(tested).select("a", "b"), "links"))
    labels = components(links)
    grouped = members.join(labels, "id", "left").select(
        "key", "id", "hub", F.coalesce("component", "id").alias("component")
    )
    # The hub has met all others. What is left of a bucket is open if it lies in more than one group.
    rest = grouped.where("id > hub")
    opened = (
        rest.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key")
    )
    rest = written(rest.join(opened, "key").select("key", "id", "component"), "open-members")
    if rest.isEmpty():
        return labels
    with freeing() as keep:
        more = keep(written(cross(rest).select("a", "b").distinct(), "links"))
    return labels if more.isEmpty() else components(links.unionByName(more))
