"""Connected components of an edge table, by alternating large-star and small-star
rounds; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import spent, written

#: A node with more edges than this, and than a 100,000th of all, is a hub: at most 200,000
#: nodes are, so what is known of them may be broadcast.
HUB_EDGES, MOST_HUBS = 100_000, 100_000


def with_least(edges: DataFrame, node: str, other: str) -> tuple[DataFrame, DataFrame]:
    """``edges`` with ``m``, the smallest ``other`` of their ``node``; and the table of these, to be
    deleted when the result is written. The minima are made with
    map-side aggregates; a hub's edges stay where they are and meet its minimum by
    a broadcast, the others by a join, so no task gets a node's edges beyond HUB_EDGES."""
    low = written(edges.groupBy(node).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    total = low.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hubs = low.where(F.col("n") > max(HUB_EDGES, total // MOST_HUBS)).select(node, "m")
    if hubs.isEmpty():
        return edges.join(low.select(node, "m"), node), low
    names = [*edges.columns, "m"]
    hubs = F.broadcast(hubs)
    rest = edges.join(hubs, node, "left_anti").join(low.select(node, "m"), node)
    return edges.join(hubs, node).select(*names).unionByName(rest.select(*names)), low


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``
    (a, b), in any direction. Loops and nulls are ignored; no edges give no rows. Nothing of
    a component is gathered in a task, nor are a hub's edges."""
    now = written(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    last = None
    while (mark := tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())) != last:
        last = mark
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select("v", "u"))
        met, least = with_least(both, "x", "y")
        large = written(met.where(F.col("y") > F.col("x")).select(F.least("x", "m").alias("u"), F.col("y").alias("v")).distinct(), "stars")
        spent(now, least)
        met, least = with_least(large, "v", "u")
        small = met.where(F.col("u") != F.col("m")).select(F.col("m").alias("u"), F.col("u").alias("v"))
        now = written(small.union(least.select(F.col("m").alias("u"), "v")).distinct(), "edges")
        spent(large, least)
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(now.select("u", "u").distinct())
