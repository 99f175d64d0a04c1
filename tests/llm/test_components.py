"""Connected components against a union-find, hubs and odd edges."""

import random

import pytest
from pyspark.sql import functions as F

from mesonlab.llm import components as C


def brute(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def found(spark, edges):
    rows = C.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("hub", [100_000, 5])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(C, "HUB_EDGES", hub)
    rng = random.Random(hub)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)] + [(1000, 1001 + i) for i in range(50)]
    edges += [(2000 + i, 1999) for i in range(40)] + [(3, 3), (None, 4), (4, None), (9000, 8000), (8000, 9000), (9000, 8000)]
    assert found(spark, edges) == brute(edges)
    assert found(spark, []) == {}


def test_a_star_is_spread_over_tasks(spark):
    """A million edges of one node: no task of the join gets more than a tenth of them."""
    star = spark.range(1, 1_000_001).select(F.lit(0).cast("long").alias("x"), F.col("id").alias("y")).repartition(25)
    both = star.union(star.select("y", "x"))
    joined, _ = C.with_least(both, "x", "y")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2_000_000 and max(sizes) <= 200_000
    assert joined.where("x = 0 AND m <> 1").isEmpty() and joined.where("x > 0 AND m <> 0").isEmpty()
