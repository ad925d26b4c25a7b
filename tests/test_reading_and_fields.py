from refloom.operators import fields as FD
from refloom.operators import reading as RD
from refloom.operators import resolve as RS


def test_choices_and_sequence(spark):
    choices = spark.createDataFrame([("c1", ["a2", "a3"]), ("c2", ["a3", "b"])], "choice_id string, options array<string>")
    profile = spark.createDataFrame([("c1", "a2")], "choice_id string, selected string")
    hidden = RD.suppressed(choices, profile)
    assert {r[0] for r in hidden.collect()} == {"a3", "b"}
    assert {r["node"]: r["choice_id"] for r in RD.choice_of(choices).collect()} == {"a2": "c1", "a3": "c1", "b": "c2"}
    layers = spark.createDataFrame([("r", 0), ("a2", 1), ("a3", 1), ("b", 2), ("c1", 5), ("z", 2)], "node string, layer int")
    assert {r["node"]: r["layer"] for r in RD.choice_layers(layers, choices).collect()}["c1"] == 1
    seq = {r["node"]: (r["previous"], r["following"]) for r in RD.sequence(layers, hidden).collect()}
    assert seq == {"r": (None, "a2"), "a2": ("r", "z"), "z": ("a2", "c1"), "c1": ("z", None)}
    assert {r["node"]: (r["x"], r["y"]) for r in RD.layout(layers).collect()}["a3"] == (238, 106)


def test_fields(spark):
    pages = spark.createDataFrame([(1, "T line\nx", {"citation_title": ["Meta"]}), (2, "First\nx", {}), (3, "Only line", None), (4, "", {})], "page_id int, text string, meta map<string,array<string>>")
    blocks = spark.createDataFrame(
        [(2, 0, "heading", "Head", None, 0, 4), (2, 1, "heading", "Abstract", None, 5, 13), (2, 2, "text", "One.", None, 14, 18), (2, 3, "text", "Two.", None, 19, 23), (2, 4, "heading", "References", None, 24, 34), (1, 0, "text", "Boxed.", "x abstract", 0, 6)],
        "page_id int, block_no int, kind string, text string, container string, start_char int, end_char int",
    )
    assert {r["page_id"]: (r["title"], r["method"]) for r in FD.titles(pages, blocks).collect()} == {1: ("Meta", "metadata"), 2: ("Head", "heading"), 3: ("Only line", "first-line"), 4: (None, None)}
    got = {(r["page_id"], r["role"]): (r["text"], r["method"], r["start_char"], r["end_char"]) for r in FD.roles(blocks).collect()}
    assert got == {(1, "abstract"): ("Boxed.", "container", 0, 6), (2, "abstract"): ("One.\nTwo.", "heading", 14, 23)}


def test_enrichment_only_for_open_references(spark):
    resolved = spark.createDataFrame([(1, "resolved", 1.0), (2, "discovered", None)], "ref_id int, status string, score double")
    refs = spark.createDataFrame([(1, "10.1234/a"), (2, "doi:10.1234/B")], "ref_id int, doi string")
    known = spark.createDataFrame([("10.1234/a", "x"), ("10.1234/b", "y")], "doi string, id string")
    assert {r["ref_id"]: r["enrichment"] for r in RS.enriched(resolved, refs, known).collect()} == {1: None, 2: "y"}
