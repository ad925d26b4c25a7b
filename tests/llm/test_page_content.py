import pytest
from pyspark.sql import functions as F

from refloom.llm import page_content as P

SHAPE = "page_id long, block_no int, kind string, text string, heading_level int, container string"
NOUNS = "lattices orders graphs trees words matroids forests blocks covers spans".split()
BODY = "The transfer matrix gives a bound for all {0} with {1} elements. The proof for {0} follows the older pattern and needs no new estimate."


def page(i):
    noun = NOUNS[i % len(NOUNS)]
    return [
        ("list_item", "Home", 0, "nav"), ("text", "Search · Browse · Sign in", 0, None), ("text", "We use cookies so that the reader works as expected.", 0, "x"), ("heading", f"Counting {noun} again", 1, "main"), ("text", f"Anna Berg{i}, Bo Chen", 0, "main"),
        ("heading", "1. Introduction", 2, "main"), ("text", BODY.format(noun, i), 0, "sidebar"), ("text", "Skip to main content", 0, "main"), ("text", "q.e.d.", 0, "main"), ("text", f"n = {i}", 0, "main"), ("heading", "References", 2, None), ("list_item", f"Anna Berg{i}. On {noun}. J. Ord. Struct. {i}, 1999.", 0, None),
        ("heading", "You may also like", 3, "main"), ("list_item", f"On the width of planar {noun}", 0, "main"), ("list_item", f"Small {noun} by size", 0, "main"), ("text", "Anzeige", 0, "main"), ("text", f"© {2000 + i} Press. All rights reserved.", 0, None), ("text", None, 0, None),
    ]


FURNITURE = {0, 1, 2, 7, 12, 13, 14, 15, 16, 17}


def frame(spark, pages):
    rows = [(p, i, *b) for p, blocks in pages.items() for i, b in enumerate(blocks)]
    return spark.createDataFrame(rows, SHAPE).withColumn("kept", F.lit(True)).withColumn("blocks", F.lit(1))


@pytest.fixture(scope="module")
def pages():
    return {i: page(i) for i in range(10)}


def furniture(df):
    return {(r["page_id"], r["block_no"]) for r in P.furniture(df).collect()}


def test_pages(spark, pages):
    df = frame(spark, pages)
    assert furniture(df.unionByName(df)) == {(p, i) for p in pages for i in FURNITURE}
    assert P.page_blocks(df).count() == sum(map(len, pages.values()))


def test_density_decides(spark, pages, monkeypatch):
    """With a density that is the same everywhere the links inside the title's section are not found."""
    model = P.fit(["Home", "Skip to main content", "Anzeige"], [BODY.format("lattices", 1)])
    right = [k for *_, k in P.judge([dict(zip(("kind", "text", "heading_level", "container"), b, strict=True), block_no=i) for i, b in enumerate(page(1))], model)]
    monkeypatch.setattr(P, "density", lambda *a: 1.0)
    flat = [k for *_, k in P.judge([dict(zip(("kind", "text", "heading_level", "container"), b, strict=True), block_no=i) for i, b in enumerate(page(1))], model)]
    assert not right[7] and not right[13] and flat[7] and flat[13]


def test_model_decides():
    blocks = [dict(zip(("kind", "text", "heading_level", "container"), b, strict=True), block_no=i) for i, b in enumerate(page(1))]
    kept = [k for *_, k in P.judge(blocks, {})]
    assert kept[7] and kept[16]  # no model, no such links


def test_pages_without_title_or_content(spark, pages):
    odd = {100: [("text", "Home | Help | Search", 0, None), ("text", BODY.format("rings", 3), 0, "footer")], 101: [("list_item", "Help", 0, None)], 102: [(None, None, None, None)]}
    assert {x for x in furniture(frame(spark, pages | odd)) if x[0] >= 100} == {(100, 0), (101, 0), (102, 0)}


def test_long_page(spark, pages):
    long = [("heading", "T", 1, None)] + [("text", BODY.format("rings", i), 0, None) for i in range(3000)] + [("text", "Skip to main content", 0, None)]
    assert {x for x in furniture(frame(spark, pages | {100: long})) if x[0] == 100} == {(100, 3001)}


def test_tree():
    root = P.tree([{"kind": k, "heading_level": n} for k, n in (("text", 0), ("heading", 1), ("text", 0), ("heading", 3), ("list_item", 0), ("text", 0), ("heading", 2), ("heading", None))])
    assert [(c.lo, c.hi) for c in root.children] == [(0, 1), (1, 8)]
    assert [(c.lo, c.hi) for c in root.children[1].children] == [(1, 2), (2, 3), (3, 5), (5, 6), (6, 7), (7, 8)]


def test_density():
    assert P.density(100, 1, 100, 1, 1000, 100) == 0 and P.density(0, 1, 0, 0, 1, 0) == 0
    assert P.density(400, 1, 0, 0, 1000, 100) > P.density(40, 1, 0, 0, 1000, 100) > P.density(40, 1, 30, 1, 1000, 100) > 0


def test_empty(spark):
    assert P.page_blocks(spark.createDataFrame([], SHAPE)).count() == 0
