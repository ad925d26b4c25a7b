import math

import pytest
from pyspark.sql import functions as F

from refloom.operators import edges as E
from refloom.operators import graph as G
from refloom.operators import rank as R


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "source string, target string")


def test_coupling_cosine(spark):
    e = edges(spark, [("A", "X"), ("A", "Y"), *[("B", t) for t in "XYZWVUTS"], ("C", "X"), (None, "X"), ("D", None)])
    rows = E.shared_pairs(e, "source", "target").collect()
    assert [(r["a"], r["b"], r["shared"], r["cosine"]) for r in rows] == [("A", "B", 2, 0.5)]
    assert {(r["a"], r["b"]) for r in E.shared_pairs(e, "source", "target", 1).collect()} == {("A", "B"), ("A", "C"), ("B", "C")}


@pytest.mark.parametrize("least", [1, 2, 3])
def test_hubs_lose_no_pair(spark, least):
    pairs = [(f"s{i}", t) for i in range(60) for t in ("hub1", "hub2") if i % 3] + [(f"s{i}", f"t{i % 7}") for i in range(60)] + [(f"s{i}", "hub3") for i in range(60)]
    got = {(r["a"], r["b"]): r["shared"] for r in E.shared_pairs(edges(spark, pairs), "source", "target", least).collect()}
    sets = {}
    for s, t in pairs:
        sets.setdefault(s, set()).add(t)
    want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= least}
    assert got == want


def test_collapsed_citations_keep_the_first(spark):
    e = spark.createDataFrame([("A", "B", "m2", 0.5, 2), ("A", "B", "m1", 0.9, 1), ("A", None, "m", 0.1, 3)], "source string, target string, method string, confidence double, at int")
    assert [tuple(r) for r in E.citations(e, ["at"]).collect()] == [("A", "B", 2, "m1", 0.9)]


def test_pagerank_mass_and_sinks(spark):
    r = {x["node"]: x["rank"] for x in G.pagerank(edges(spark, [("A", "D"), ("B", "D"), ("C", "D")]), "source", "target").collect()}
    assert math.isclose(sum(r.values()), 1) and r["D"] > r["A"] == pytest.approx(r["B"])
    r = {x["node"]: x["rank"] for x in G.pagerank(edges(spark, [("A", "B"), ("B", "A")]), "source", "target").collect()}
    assert r["A"] == pytest.approx(0.5)
    assert G.pagerank(edges(spark, []), "source", "target").count() == 0


def test_order_layers_closure(spark):
    dag = edges(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("e", "d")])
    assert G.topological_order(dag, "source", "target") == ["a", "b", "c", "e", "d"]
    assert {r["node"]: r["layer"] for r in G.layers(dag, "source", "target").collect()} == {"a": 0, "e": 0, "b": 1, "c": 1, "d": 2}
    assert {(r[0], r[1]) for r in G.closure(dag, "source", "target").collect()} == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "d"), ("c", "d"), ("e", "d")}
    depth = G.layers(dag, "source", "target")
    assert {r["node"]: r["parent"] for r in G.best_parents(dag, depth, "source", "target").collect()}["d"] == "b"
    loop = edges(spark, [("a", "b"), ("b", "a"), ("b", "c"), ("x", "y")])
    with pytest.raises(ValueError, match="a, b, c"):
        G.topological_order(loop, "source", "target")
    assert {r["node"] for r in G.layers(loop, "source", "target").collect()} == {"x", "y"}
    assert ("a", "a") in {(r[0], r[1]) for r in G.closure(loop, "source", "target").collect()}
    with pytest.raises(G.GraphTooLarge):
        G.topological_order(dag, "source", "target", most=2)
    with pytest.raises(G.GraphTooLarge):
        G.guard(dag, 3, 100)


def test_general_graphs(spark):
    from refloom.operators import hierarchy as H

    # a long chain, a diamond beside a direct link, two cycles with a node in common, what leads there and away, a loop
    links = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n0", "n11"), ("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("p", "q"), ("q", "r"), ("r", "p"), ("r", "s"), ("s", "r"), ("o", "p"), ("s", "t"), ("d", "t"), ("k", "k")]
    e = edges(spark, links)
    got = {r["node"]: r["layer"] for r in G.layers(e, "source", "target").collect()}
    assert got == {f"n{i}": i for i in range(13)} | {"a": 0, "b": 1, "c": 2, "d": 3, "o": 0}
    ring = G.cut(G.on_cycles(e, "source", "target"))
    assert {r["node"]: r["next"] for r in ring.collect()} == {"p": "q", "q": "r", "r": "p", "s": "r", "k": "k"}
    assert {r["node"] for r in G.concrete_cycles(ring).collect()} == {"p", "q", "r", "k"}
    assert G.on_cycles(edges(spark, []), "source", "target").count() == 0 and G.layers(edges(spark, []), "source", "target").count() == 0
    pairs = e.toDF("parent", "child")
    assert ("b", "c") in {tuple(r) for r in H.other_parents(pairs).collect()}


def test_normalised_and_sensitivity(spark):
    rows = spark.createDataFrame([("a", 0, 5.0), ("b", 5, 5.0), ("c", 10, 5.0)], "node string, x int, y double")
    n = {r["node"]: (r["n_x"], r["n_y"]) for r in R.normalised(rows, ["x", "y"]).collect()}
    assert n == {"a": (0.0, 0.0), "b": (0.5, 0.0), "c": (1.0, 0.0)}
    assert R.scored(rows.limit(0), {"x": 1.0}).count() == 0
    grid = R.sensitivity(rows, {"x": 0.5, "y": 0.5}, (-0.1, 0.1), 2, then="x").collect()
    assert len(grid) == 4 and all(r["entered"] == "" and not r["changed"] for r in grid)


def test_author_credit(spark):
    a = E.authorship(spark.createDataFrame([("w", ["Cleo Duarte", "A. Rivera", None])], "w string, a array<string>"), "w", "a", 0.5, "x")
    got = {r["author"]: (r["credit"], r["coauthors"]) for r in R.author_credit(a, spark.createDataFrame([("w", 2)], "target string, indegree long")).collect()}
    assert got == {"author:duarte c": (1.0, 1), "author:rivera a": (1.0, 1)}


def test_merge_records(spark):
    rows = [("l1", "A Title", ["Bo Chen"], 2020, None, None), ("d1", "a title!", ["B. Chen"], 2020, "10.1/x", None), ("l2", "A Title", ["Bo Chen"], 2021, None, None), ("l3", "A Title", None, 2020, None, None)]
    got = dict(map(tuple, E.merge_records(spark.createDataFrame(rows, "id string, title string, authors array<string>, year int, doi string, isbn string")).collect()))
    assert got == {"l1": "d1", "d1": "d1", "l2": "l2", "l3": "l3"}


def test_merged_and_promoted(spark):
    rows = [("l1", "A Title", ["Bo Chen"], 2020, None, "i1", ["x", "y"]), ("d1", "a title!", ["B. Chen"], 2020, "10.1/x", None, ["y", None]), ("l2", "Other", None, None, None, None, None), (None, "x", None, None, None, None, ["z"])]
    df = spark.createDataFrame(rows, "id string, title string, authors array<string>, year int, doi string, isbn string, cited_by array<string>")
    got = {r["id"]: (r["doi"], r["isbn"], r["cited_by"], r["merged_from"]) for r in E.merged_records(df).collect()}
    assert got == {"d1": ("10.1/x", "i1", "x y", "l1"), "l2": (None, None, "", "")}
    assert sorted(map(tuple, E.promoted(df, E.merge_records(df)).collect())) == [("x", "d1", 1), ("y", "d1", 2)]


def test_author_ranking(spark):
    a = E.authorship(spark.createDataFrame([("w", ["Cleo Duarte", "A. Rivera"]), ("v", ["C. Duarte"])], "w string, a array<string>"), "w", "a", 0.5, "x")
    degree, groups, best = spark.createDataFrame([("w", 2)], "target string, indegree long"), spark.createDataFrame([("w", "A"), ("v", "B")], "work string, grp string"), spark.createDataFrame([("w",)], "work string")
    got = {r["author"]: (r["display_names"], r["works"], r["credit"], r["seed_groups"], r["top_contribution"], r["identity_basis"]) for r in R.author_ranking(a, degree, groups, best).collect()}
    assert got == {"author:duarte c": ("C. Duarte; Cleo Duarte", 2, 1.0, 2, 0.5, "x"), "author:rivera a": ("A. Rivera", 1, 1.0, 1, 0.5, "x")}


def test_latest(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, at int, v string")
    assert sorted(map(tuple, E.latest(log, "k", "at").collect())) == [("a", 2, "y"), ("b", 1, None)]
    assert log.select(F.count("*")).first()[0] == 3
