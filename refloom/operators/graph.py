"""Graph operators: closure, layers, topological order, PageRank, adjacency."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.operators.hierarchy import cycle_nodes
from refloom.plans.materialize import cut, drop


class GraphTooLarge(ValueError):
    """A bound on vertices or edges is exceeded."""


def guard(edges: DataFrame, vertices: int, most: int) -> None:
    """Refuse a graph beyond the bounds before anything is derived from it."""
    n = edges.count()
    v = edges.select(F.explode(F.array(*edges.columns[:2]))).distinct().count()
    if n > most or v > vertices:
        raise GraphTooLarge(f"{v} vertices and {n} edges exceed {vertices} and {most}")


def closure(edges: DataFrame, start: str, end: str) -> DataFrame:
    """(node, reached): every node that can be reached from each, itself only over a cycle (`where("node <> reached")` leaves it out).

    The relation is composed with itself until it stops growing, so a path of length d takes log2(d) rounds; a round
    composes what the last one found with all that is known.
    """
    e = edges.select(F.col(start).alias("node"), F.col(end).alias("reached")).where("node is not null and reached is not null").distinct()
    known = fresh = cut(e)
    while not fresh.isEmpty():
        onward = known.select(F.col("node").alias("via"), F.col("reached").alias("to"))
        step = fresh.join(onward, fresh["reached"] == onward["via"]).select("node", F.col("to").alias("reached"))
        back = known.join(fresh.select(F.col("node").alias("via"), F.col("reached").alias("to")), F.col("reached") == F.col("via")).select("node", F.col("to").alias("reached"))
        new = cut(step.unionByName(back).distinct().join(known, ["node", "reached"], "left_anti"))
        known, fresh = cut(known.unionByName(new)), new
    return known


def tops(parents: DataFrame) -> DataFrame:
    """(node, root, depth) of links (parent, child) with one parent a child: the node where each child's chain of parents ends.

    Pointer jumping: round k ends the chains of up to 2^k links. A round that ends none has only chains left that lead
    into a cycle; those give no row. A parent with very many children meets a one-row side.
    """
    at, left = cut(parents.select(F.col("child").alias("v"), F.col("parent").alias("to"), F.lit(1).alias("d"), F.lit(False).alias("done"))), None
    while True:
        ahead = at.select(F.col("v").alias("to"), F.col("to").alias("onward"), F.col("d").alias("more"), F.col("done").alias("ended"))
        step = at.where("not done").join(ahead, "to", "left")
        moved = step.select("v", F.coalesce("onward", "to").alias("to"), (F.col("d") + F.coalesce("more", F.lit(0))).alias("d"), (F.col("onward").isNull() | F.col("ended")).alias("done"))
        new = cut(moved.unionByName(at.where("done")))
        drop(at)
        at = new
        n = at.where("not done").count()
        if n == 0 or n == left:
            return at.where("done").select(F.col("v").alias("node"), F.col("to").alias("root"), F.col("d").alias("depth"))
        left = n


def layers(edges: DataFrame, before: str, after: str) -> DataFrame:
    """(node, layer): the longest path to each node, for the nodes that no cycle leads to.

    Nodes with one parent hang in trees below nodes with several or none, and their depth there takes a logarithmic
    number of rounds (`tops`). Only the nodes with several parents wait for each other: one round for each on the
    longest chain of them, over links from tree roots weighted by the depth at which they leave the tree. A null end
    joins nothing; a link to itself is a cycle.
    """
    e = cut(edges.select(F.col(before).alias("p"), F.col(after).alias("c")).where("p is not null and c is not null").distinct())
    many = cut(e.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c"))
    forest = cut(e.join(many, "c", "left_anti").select(F.col("p").alias("parent"), F.col("c").alias("child")))
    nodes = e.select(F.explode(F.array("p", "c")).alias("node")).distinct()
    own = nodes.join(forest.select(F.col("child").alias("node")), "node", "left_anti")
    # what has no single parent is a root of its own; what a chain of parents leads into a cycle has none
    below = nodes.join(forest.select(F.col("child").alias("node")), "node", "left_semi").join(tops(forest), "node", "left")
    place = cut(own.select("node", F.col("node").alias("root"), F.lit(0).alias("depth")).unionByName(below.select("node", "root", F.coalesce("depth", F.lit(0)).alias("depth"))))
    into = cut(e.join(many, "c").join(place.toDF("p", "r", "w"), "p").select("r", "c", (F.col("w") + 1).alias("w")))
    known = cut(place.where("root = node").join(many.toDF("node"), "node", "left_anti").select(F.col("node").alias("r"), F.lit(0).alias("base")))
    while not into.isEmpty():
        met = into.join(known, "r", "left").groupBy("c").agg(F.max(F.col("base") + F.col("w")).alias("base"), F.count("*").alias("n"), F.count("base").alias("k"))
        ready = cut(met.where("n = k").select(F.col("c").alias("r"), "base"))
        if ready.isEmpty():
            break
        rest = cut(into.join(ready.select(F.col("r").alias("c")), "c", "left_anti"))
        more = cut(known.unionByName(ready))
        drop(into)
        drop(known)
        into, known = rest, more
    return place.join(known.toDF("root", "base"), "root").select("node", (F.col("base") + F.col("depth")).cast("int").alias("layer"))


def on_cycles(edges: DataFrame, before: str, after: str) -> DataFrame:
    """(node, next): each node on a cycle with the smallest next node on a cycle through both, all links considered.

    What no cycle leads to, and of the rest what leads to no cycle, is peeled off. On what remains the nodes that reach
    each other are on cycles together.
    """
    e = cut(edges.select(F.col(before).alias("p"), F.col(after).alias("c")).where("p is not null and c is not null").distinct())
    clear = layers(e, "p", "c").select("node")
    e1 = cut(e.join(clear.toDF("p"), "p", "left_anti"))
    lead = layers(e1, "c", "p").select("node")
    core = cut(e1.join(lead.toDF("c"), "c", "left_anti").join(lead.toDF("p"), "p", "left_anti"))
    reach = closure(core, "p", "c")
    back = reach.select(F.col("node").alias("c"), F.col("reached").alias("p"))
    return core.join(back, ["p", "c"], "left_semi").groupBy(F.col("p").alias("node")).agg(F.min("c").alias("next"))


def concrete_cycles(ring: DataFrame) -> DataFrame:
    """(node, next) of the cycles that following `next` from every node of `on_cycles` ends in: one path for each group of nodes, or more."""
    there = cycle_nodes(ring.select(F.col("node").alias("child"), F.col("next").alias("parent")))
    return ring.join(there, "node", "left_semi")


def topological_order(edges: DataFrame, before: str, after: str, most: int = 500_000) -> list[str]:
    """The order in which the smallest ready node comes first. It is sequential by definition, so the graph is bounded.

    Raises GraphTooLarge beyond `most` edges and ValueError naming the nodes that a cycle keeps from an order.
    """
    e = edges.select(before, after).where(F.col(before).isNotNull() & F.col(after).isNotNull()).distinct()
    rows = e.limit(most + 1).collect()
    if len(rows) > most:
        raise GraphTooLarge(f"more than {most} edges")
    children: dict[str, list[str]] = {}
    waits: dict[str, int] = {}
    for p, c in rows:
        children.setdefault(p, []).append(c)
        waits[c] = waits.get(c, 0) + 1
        waits.setdefault(p, 0)
    ready = [n for n, w in waits.items() if w == 0]
    heapq.heapify(ready)
    out = []
    while ready:
        n = heapq.heappop(ready)
        out.append(n)
        for c in children.get(n, ()):
            waits[c] -= 1
            if waits[c] == 0:
                heapq.heappush(ready, c)
    if len(out) < len(waits):
        raise ValueError("no order for " + ", ".join(sorted(set(waits) - set(out))))
    return out


def best_parents(edges: DataFrame, depth: DataFrame, before: str, after: str) -> DataFrame:
    """(node, parent): of a node's parents the deepest, of several the smallest; following it gives the canonical path."""
    e = edges.select(F.col(before).alias("p"), F.col(after).alias("node")).distinct()
    deep = e.join(depth.withColumnRenamed("node", "p"), "p")
    return deep.groupBy("node").agg(F.min_by("p", F.struct((-F.col("layer")).alias("l"), "p")).alias("parent"))


def pagerank(edges: DataFrame, source: str, target: str, damping: float = 0.85, iterations: int = 100, tolerance: float = 1e-10) -> DataFrame:
    """(node, rank) on the distinct edges; vertices are their ends, sinks give to all, the ranks add up to 1.

    Each round is one join and one aggregation with partial sums before its exchange, and one small job for the change and the
    sinks' mass. A hub's incoming mass is summed before it moves.
    """
    e = cut(edges.select(F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null").distinct())
    out = e.groupBy("s").agg(F.count("*").alias("d"))
    nodes = e.select(F.explode(F.array("s", "t")).alias("node")).distinct()
    nodes = cut(nodes.join(out.withColumnRenamed("s", "node"), "node", "left"))
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    ranks = cut(nodes.withColumn("rank", F.lit(1.0 / n)))
    sinks = ranks.where("d is null").count() / n
    for _ in range(iterations):
        base = (1 - damping) / n + damping * sinks / n
        given = e.join(ranks.where("d is not null").select(F.col("node").alias("s"), (F.col("rank") / F.col("d")).alias("g")), "s").groupBy(F.col("t").alias("node")).agg(F.sum("g").alias("g"))
        new = cut(ranks.join(given, "node", "left").select("node", "d", (F.lit(base) + F.lit(damping) * F.coalesce("g", F.lit(0.0))).alias("rank"), F.col("rank").alias("was")))
        change, sinks = new.agg(F.sum(F.abs(F.col("rank") - F.col("was"))), F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("rank"))), F.lit(0.0))).first()
        drop(ranks)
        ranks = new
        if change < tolerance:
            break
    total = ranks.agg(F.sum("rank")).first()[0]
    return ranks.select("node", (F.col("rank") / F.lit(total)).alias("rank"))


def adjacency(edges: DataFrame, source: str, target: str, kind: str) -> DataFrame:
    """(node, outgoing, incoming): sorted lists of kind and other end, joined as text."""
    e = edges.select(F.col(source).alias("s"), F.col(target).alias("t"), F.col(kind).alias("k")).where("s is not null and t is not null").distinct()
    text = lambda c: F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "k", c))), " ")
    o = e.groupBy(F.col("s").alias("node")).agg(text("t").alias("outgoing"))
    i = e.groupBy(F.col("t").alias("node")).agg(text("s").alias("incoming"))
    return o.join(i, "node", "full").select("node", F.coalesce("outgoing", F.lit("")).alias("outgoing"), F.coalesce("incoming", F.lit("")).alias("incoming"))
