"""Connected components of a link table by hooking and contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import small, stored

# Labels of at most so many nodes go to all executors in every round and are written by a few tasks; more are shuffled.
BROADCAST_NODES = 50_000
FEW_TASKS = 8


def components(links: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """(node, component) of every node in `links` (a, b); the component is its smallest node.

    Each round gives a node the neighbour of the smallest hash, if that is smaller than its own, then the one
    that this neighbour has been given; links between nodes that got the same one are dropped, the others go on as
    links between these, so a round only works on what is not settled. Hashes differ from round to round, so a
    chain is cut into short pieces whatever its order. A hub's neighbours are combined before the shuffle, and every
    round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "links")
    levels: list[tuple[DataFrame, Callable[[DataFrame], DataFrame]]] = []
    while True:
        def order(name: str, salt: int = len(levels)) -> Column:
            return F.xxhash64(F.lit(salt), F.col(name))

        near = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", order("b")).alias("near"))
        given = near.select("node", F.when(order("near") < order("node"), F.col("near")).otherwise(F.col("node")).alias("given"))
        given = stored(given, "given")
        few = small(given, broadcast_nodes)
        hint = F.broadcast if few else (lambda df: df)
        further = given.select(F.col("node").alias("given"), F.col("given").alias("root"))
        labels = given.join(hint(further), "given").select("node", "root")
        labels = stored(labels.coalesce(FEW_TASKS) if few else labels, "labels")
        levels.append((labels, hint))
        ends = [labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab"]
        left = both.join(hint(ends[0]), "a").join(hint(ends[1]), "b").filter("ra <> rb")
        left = left.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        both = stored(left.coalesce(FEW_TASKS) if few else left, "links")
        if both.isEmpty():
            break
    roots, hint = levels.pop()
    while levels:  # what the roots of the round before have become
        onward = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels, wider = levels.pop()
        joined = labels.join(hint(onward), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots, hint = stored(joined, "roots"), wider
    lowest = roots.groupBy("root").agg(F.min("node").alias("component"))
    return stored(roots.join(hint(lowest), "root").select("node", "component"), "components")


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components `labels` (node, component) after more `links` (a, b), as `components` of all links gives them.

    Only the components that the new links touch are worked on; nodes that are new here are added.
    """
    links = stored(links.select("a", "b"), "more")
    if links.isEmpty():
        return labels
    hint = F.broadcast if small(links, BROADCAST_NODES // 2) else (lambda df: df)
    ends = hint(links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct())
    # of the nodes the links name; one that is new is its own component
    named = stored(ends.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "named")
    between = links.join(named.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
    between = between.join(named.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
    merged = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("lowest"))
    every = labels.join(named.select("node"), "node", "left_anti").unionByName(named)
    return every.join(merged, "component", "left").select("node", F.coalesce("lowest", "component").alias("component"))
