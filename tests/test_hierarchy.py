import random

import pytest
from pyspark.sql import functions as F

from refloom.operators import hierarchy as H


def brute(pairs):
    """{node: (root, depth)} by walking up; '-' with -1 on a cycle and -2 below one."""
    parent = {}
    for p, c in pairs:
        if p is not None and c is not None:
            parent[c] = min(p, parent.get(c, p))
    nodes = {x for p, c in pairs if p is not None and c is not None for x in (p, c)}
    out = {}
    for n in nodes:
        seen, x = [n], n
        while x in parent and parent[x] not in seen:
            x = parent[x]
            seen.append(x)
        if x not in parent:
            out[n] = (x, len(seen) - 1)
        else:
            out[n] = ("-", -1 if parent[x] == n else -2)
    return out


def df(spark, pairs):
    return spark.createDataFrame(pairs, "from_node string, to_node string")


def got(spark, pairs):
    return {r["node_id"]: (r["root_id"], r["depth"]) for r in H.found(H.links(df(spark, pairs), "from_node", "to_node")).collect()}


def test_random_forest_with_cycles(spark):
    rng = random.Random(5)
    pairs = [(f"n{rng.randrange(i)}", f"n{i}") for i in range(1, 120)] + [("a", "b"), ("b", "c"), ("c", "a"), ("c", "x"), ("x", "y"), ("s", "s"), ("s", "t")]
    assert got(spark, pairs) == brute(pairs)


def test_star_chain_repeats_and_nulls(spark):
    pairs = [("hub", f"s{i}") for i in range(300)] + [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("hub", "s1")] * 3 + [(None, "lost"), ("lost2", None)]
    assert got(spark, pairs) == brute(pairs)


def test_several_parents_take_the_smallest(spark):
    pairs = [("b", "x"), ("a", "x"), ("r", "a"), ("r", "b")]
    assert got(spark, pairs)["x"] == ("r", 2) and brute(pairs)["x"] == ("r", 2)


def test_empty_and_only_cycle(spark):
    assert got(spark, []) == {}
    assert got(spark, [("a", "a")]) == {"a": ("-", -1)}


def test_kinds_compare_without_case_and_blanks(spark):
    e = spark.createDataFrame([("a", "b", " Prerequisite "), ("b", "c", "backup"), ("b", "d", None)], "f string, t string, kind string")
    assert [tuple(r) for r in H.links(e, "f", "t", "kind").collect()] == [("a", "b")]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_paths_whatever_the_block(spark, block):
    rng = random.Random(7)
    pairs = [(f"n{rng.randrange(max(0, i - 3), i)}", f"n{i}") for i in range(1, 40)] + [("p", "q")]
    parent = {c: p for p, c in pairs}
    tree = H.cut(H.hierarchy(H.links(df(spark, pairs), "from_node", "to_node")))
    paths = {r["node_id"]: r["path"] for r in H.paths(tree, block).collect()}
    for n, path in paths.items():
        want = [n]
        while want[0] in parent:
            want.insert(0, parent[want[0]])
        assert path == want
    assert len(paths) == 42
    below = {r["node_id"]: r["descendants"] for r in tree.collect()}
    assert all(below[n] == sum(n in p[:-1] for p in paths.values()) for n in paths)


def test_intervals_nest(spark):
    pairs = [("r", "a"), ("a", "b"), ("r", "c"), ("b", "d")]
    t = {r["node_id"]: r for r in H.hierarchy(H.links(df(spark, pairs), "from_node", "to_node")).collect()}
    inside = lambda v, u: t[u]["entry"] < t[v]["entry"] and t[v]["exit"] < t[u]["exit"]
    assert inside("d", "a") and inside("b", "r") and not inside("c", "a") and not inside("a", "b")


def test_extra_columns_with_clashing_names(spark):
    e = df(spark, [("a", "b")]).withColumn("parent", F.lit(1)).withColumn("child", F.lit(2)).withColumn("kind", F.lit("x"))
    assert H.links(e, "from_node", "to_node").columns == ["parent", "child"]
    assert [tuple(r) for r in H.links(e, "from_node", "to_node").collect()] == [("a", "b")]
