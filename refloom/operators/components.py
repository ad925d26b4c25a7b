"""Connected components by alternating large-star and small-star steps.

Each step joins an edge list with one minimum per vertex and never makes the list longer, and the number of rounds grows
with the logarithm of the component size. A vertex with very many neighbours meets a one-row side, so adaptive
execution may split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.plans.materialize import cut, drop


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v. Link each vertex's larger (or else smaller) neighbours to the smallest of its own."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(least, "u")
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): component is the smallest node that can be reached. Nodes without an edge do not occur.

    A null end or an edge to itself joins nothing; repeated edges count once; an empty table gives an empty result.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    e = cut(e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    sign = None
    while True:
        large = cut(_star(e, True))
        small = cut(_star(large, False))
        drop(large)
        drop(e)
        e = small
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == sign:
            break
        sign = now
    # every edge now leads to its component's smallest node
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
