"""Parent-child links to full hierarchies: Euler tours ranked in parallel.

Every node has at most one parent in a hierarchy: of several the smallest is taken, and `other_parents` lists the links left out. Cycles come to light by
peeling leaves, 2^k layers in round k, so that a chain of depth d takes log2(d) rounds instead of d. The forest that
is left once the links inside cycles are cut is walked by an Euler tour: every link gives an arc down and an arc up,
each arc knows its successor, and pointer jumping ranks all tours at once in log2(longest tour) rounds. The ranks
of a node's two arcs are its entry and exit; they give depth, root, ancestors, paths and descendants.

Nothing here gathers a node's children, a tree or a cycle in one task. Siblings are chained after a range sort
(a parent may hold a third of all rows), tour successors are one-to-one, and paths are swept in blocks of the tour.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.plans.materialize import cut, drop

#: Link types that order nodes (fixed values).
ORDERING = ("prerequisite", "conditional", "orientation", "historical")
#: Arcs of a tour that one block of the path sweep holds.
BLOCK = 20_000


def links(edges: DataFrame, parent: str, child: str, kind: str | None = None, kinds: tuple[str, ...] = ORDERING) -> DataFrame:
    """(parent, child), distinct, of the links of the wanted kinds.

    A link with a null end joins nothing and adds no node; repeated links count once; a kind compares without case
    and outer blanks; other columns are ignored whatever their names. An empty table gives an empty result.
    """
    df = edges.select(F.col(parent).cast("string").alias("parent"), F.col(child).cast("string").alias("child"), *([F.col(kind).alias("kind")] if kind else []))
    if kind:
        df = df.where(F.lower(F.regexp_replace("kind", r"^\s+|\s+$", "")).isin(*kinds))
    return df.where("parent is not null and child is not null").select("parent", "child").distinct()


def other_parents(pairs: DataFrame) -> DataFrame:
    """(parent, child): the links that `hierarchy` leaves out because their child has a smaller parent too."""
    one = pairs.groupBy("child").agg(F.min("parent").alias("least"))
    return pairs.join(one, "child").where("parent <> least").select("parent", "child")


def cycle_nodes(parents: DataFrame) -> DataFrame:
    """(node): the nodes on a cycle, a link to itself included. `parents` has one row (parent, child) per child.

    Peeling the leaves of h layers leaves the nodes of height h and more. They are the image of the h-fold parent
    map, so each round squares the map on what is left and keeps its image; once a round peels nothing, what is left
    has no finite height.
    """
    jump = cut(parents.select(F.col("child").alias("v"), F.col("parent").alias("to")))
    left = None
    while True:
        alive = jump.select(F.col("to").alias("v")).distinct()
        kept = cut(jump.join(alive, "v", "left_semi"))
        n = kept.count()
        drop(jump)
        if n == left or n == 0:
            return kept.select(F.col("v").alias("node"))
        left = n
        onward = kept.select(F.col("v").alias("to"), F.col("to").alias("onward"))
        jump = cut(kept.join(onward, "to").select("v", F.col("onward").alias("to")))
        drop(kept)


def _sibling_chain(forest: DataFrame) -> DataFrame:
    """(id, parent, child, next_id): ids in the order of (parent, child), next_id that of the next sibling."""
    spread = forest.repartitionByRange("parent", "child").sortWithinPartitions("parent", "child")
    rows = cut(spread.select("parent", "child", F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("pid")))
    own = W.partitionBy("pid", "parent").orderBy("id")
    heads = rows.groupBy("pid").agg(F.min_by(F.struct("id", "parent"), "id").alias("head"), F.max("id").alias("last"))
    # one row per partition: the head of the partition that follows
    follow = heads.select(F.col("last").alias("id"), F.lead("head").over(W.orderBy("pid")).alias("head"))
    rows = rows.join(F.broadcast(follow), "id", "left")
    beyond = F.when(F.col("head.parent") == F.col("parent"), F.col("head.id"))
    return rows.select("id", "parent", "child", F.coalesce(F.lead("id").over(own), beyond).alias("next_id"))


def _rank(arcs: DataFrame) -> DataFrame:
    """Pointer jumping over (arc, next, dist, depth, root, cyclic); next is null at the end of a tour.

    dist and depth become the sums from the arc to the end of its tour, root and cyclic what the end says. Successors
    are one-to-one, so neither side of the join is ever skewed.
    """
    done = arcs
    while not done.where("next is not null").isEmpty():
        ahead = done.select(F.col("arc").alias("next"), F.col("next").alias("n2"), F.col("dist").alias("d2"), F.col("depth").alias("w2"), F.col("root").alias("r2"), F.col("cyclic").alias("c2"))
        step = done.where("next is not null").join(ahead, "next").select("arc", F.col("n2").alias("next"), (F.col("dist") + F.col("d2")).alias("dist"), (F.col("depth") + F.col("w2")).alias("depth"), F.col("r2").alias("root"), F.col("c2").alias("cyclic"))
        new = cut(step.unionByName(done.where("next is null")))
        drop(done)
        done = new
    return done


def hierarchy(pairs: DataFrame) -> DataFrame:
    """(node_id, parent_id, root_id, depth, entry, exit, descendants, status) for every node of the links (parent, child).

    status is `tree`, `cycle` or `below` (a cycle). Nodes on a cycle have no root, depth, entry or exit, those below
    one have no root and depth; entry < exit number the arcs of the node's tour and nest: v lies below u when both
    have the same tour and u.entry < v.entry < u.exit. `tour` names the tour (its top node).
    """
    one = cut(pairs.groupBy("child").agg(F.min("parent").alias("parent")))
    cycles = cut(cycle_nodes(one))
    forest = one.join(cycles.withColumnRenamed("node", "child"), "child", "left_anti")
    chain = cut(_sibling_chain(forest))
    first = chain.groupBy(F.col("parent").alias("child")).agg(F.min("id").alias("first_id"))
    down = chain.join(first, "child", "left").select(
        (F.col("id") * 2).alias("arc"), (F.coalesce(F.col("first_id") * 2, F.col("id") * 2 + 1)).alias("next"), F.lit(1).alias("w"), F.lit(None).cast("string").alias("root")
    )
    # only the last child of each parent looks its parent's arc up: one row per parent
    above = chain.select(F.col("child").alias("parent"), F.col("id").alias("up_id"))
    last = chain.where("next_id is null").join(above, "parent", "left").select(
        (F.col("id") * 2 + 1).alias("arc"), (F.col("up_id") * 2 + 1).alias("next"), F.lit(-1).alias("w"), F.when(F.col("up_id").isNull(), F.col("parent")).alias("root")
    )
    other = chain.where("next_id is not null").select((F.col("id") * 2 + 1).alias("arc"), (F.col("next_id") * 2).alias("next"), F.lit(-1).alias("w"), F.lit(None).cast("string").alias("root"))
    ends = cycles.select(F.col("node").alias("root"), F.lit(True).alias("cyclic"))
    last = last.join(ends, "root", "left").select("arc", "next", "w", "root", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    plain = down.unionByName(other).withColumn("cyclic", F.lit(False))
    arcs = cut(plain.unionByName(last).select("arc", "next", F.lit(1).cast("long").alias("dist"), F.col("w").cast("long").alias("depth"), "root", "cyclic"))
    ranked = _rank(arcs)
    both = (
        ranked.groupBy(F.floor(F.col("arc") / 2).cast("long").alias("id"))
        .agg(
            F.max("dist").alias("dist_in"), F.min("dist").alias("dist_out"), F.max(F.when(F.col("arc") % 2 == 0, F.col("depth"))).alias("rest"),
            F.max("root").alias("root"), F.max("cyclic").alias("cyclic"),
        )
    )
    nodes = chain.select("id", "parent", "child").join(both, "id")
    below = nodes.select(
        F.col("child").alias("node_id"), F.col("parent").alias("parent_id"), F.col("root").alias("tour"),
        F.when(~F.col("cyclic"), F.col("root")).alias("root_id"), F.when(~F.col("cyclic"), 1 - F.col("rest")).cast("int").alias("depth"),
        (-F.col("dist_in")).alias("entry"), (-F.col("dist_out")).alias("exit"), F.expr("(dist_in - dist_out - 1) div 2").alias("descendants"),
        F.when(F.col("cyclic"), "below").otherwise("tree").alias("status"),
    )
    tops = nodes.groupBy("root", "cyclic").agg(F.max("dist_in").alias("n"))
    heads = tops.where("not cyclic").select(
        F.col("root").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.col("root").alias("tour"), F.col("root").alias("root_id"), F.lit(0).alias("depth"),
        (-F.col("n") - 1).alias("entry"), F.lit(0).cast("long").alias("exit"), F.expr("n div 2").alias("descendants"), F.lit("tree").alias("status"),
    )
    rings = cycles.withColumnRenamed("node", "child").join(one, "child").select(
        F.col("child").alias("node_id"), F.col("parent").alias("parent_id"), F.lit(None).cast("string").alias("tour"), F.lit(None).cast("string").alias("root_id"),
        F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("entry"), F.lit(None).cast("long").alias("exit"), F.lit(None).cast("long").alias("descendants"), F.lit("cycle").alias("status"),
    )
    return below.unionByName(heads).unionByName(rings)


def _sweep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk arcs sorted by (tour, block, kind, at): first the nodes open at the block's start, then its arcs."""
    key, stack = None, []
    for pdf in parts:
        nodes, paths = [], []
        for tour, block, kind, node, enters in zip(pdf["tour"], pdf["block"], pdf["kind"], pdf["node_id"], pdf["enters"], strict=True):
            if (tour, block) != key:
                key, stack = (tour, block), []
            if not enters:
                stack.pop()
                continue
            stack.append(node)
            if kind:
                nodes.append(node)
                paths.append(list(stack))
        yield pd.DataFrame({"node_id": nodes, "path": paths})


def paths(tree: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node_id, path array<string>): from the root to the node itself, for the nodes of `hierarchy` in trees.

    A tour is cut into blocks of `block` arcs, swept with a stack that starts with the nodes open there: those whose
    interval spans the block's first arc. No task holds more than one block and its open nodes, however large the tree.
    """
    t = tree.where("status = 'tree'").select("node_id", "tour", (-F.col("exit")).alias("hi"), (-F.col("entry")).alias("lo"))
    # distances to the end count down along the tour; `at` counts up
    at_in, at_out = -F.col("lo"), -F.col("hi")
    n = F.lit(block)
    arcs = t.select("tour", F.floor(at_in / n).alias("block"), F.lit(1).alias("kind"), at_in.alias("at"), "node_id", F.lit(True).alias("enters")).unionByName(
        t.select("tour", F.floor(at_out / n).alias("block"), F.lit(1).alias("kind"), at_out.alias("at"), "node_id", F.lit(False).alias("enters"))
    )
    spans = t.withColumn("b0", F.floor(at_in / n) + 1).withColumn("b1", F.floor(at_out / n)).where("b1 >= b0")
    opened = spans.select("tour", F.explode(F.sequence("b0", "b1")).alias("block"), F.lit(0).alias("kind"), at_in.alias("at"), "node_id", F.lit(True).alias("enters"))
    rows = opened.unionByName(arcs).repartition("tour", "block").sortWithinPartitions("tour", "block", "kind", "at")
    return rows.mapInPandas(_sweep, "node_id string, path array<string>")


def found(pairs: DataFrame) -> DataFrame:
    """(node_id, root_id, depth) with '-' and -1 on a cycle, '-' and -2 below one."""
    h = hierarchy(pairs)
    return h.select("node_id", F.coalesce("root_id", F.lit("-")).alias("root_id"), F.coalesce("depth", F.when(F.col("status") == "cycle", -1).otherwise(-2)).cast("int").alias("depth"))
