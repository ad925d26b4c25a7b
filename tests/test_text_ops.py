from pyspark.sql import functions as F

from refloom.operators import extract as X
from refloom.operators import resolve as RS
from refloom.operators import rights as RT
from refloom.operators import terms as T
from refloom.operators import validate as V


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_lines(spark):
    rows = X.lines(docs(spark, "ab\n\ncd", None), "doc_id", "text").orderBy("line_no").collect()
    assert [(r["line"], r["start"], r["blank_before"], r["blank_after"]) for r in rows] == [("ab", 0, True, True), ("", 3, False, False), ("cd", 4, True, True)]


def test_references_numbered_and_hanging(spark):
    num = "[1] First ref\n  goes on\n[2] Second\n\nloose\n[3] Third"
    hang = "Alpha one\n  more\nBeta two\n\n  indented starts"
    rows = X.segment_references(docs(spark, num, hang, "", None), "doc_id", "text").orderBy("doc", "ref_no").collect()
    assert [r["raw"] for r in rows if r["doc"] == 0] == ["[1] First ref goes on", "[2] Second", "loose", "[3] Third"]
    assert [r["raw"] for r in rows if r["doc"] == 1] == ["Alpha one more", "Beta two", "indented starts"]
    assert {r["doc"] for r in rows} == {0, 1}


def test_roles_and_headings(spark):
    df = spark.createDataFrame([("Discussion and Conclusions",), ("4. Conclusions",), ("Literatur",), ("Transfer matrices",), ("Résumé",), ("Abstract algebra",)], "x string")
    assert [r[0] for r in df.select(X.role(F.col("x"))).collect()] == ["conclusion", "conclusion", "references", None, "abstract", "abstract"]
    h = docs(spark, "1. Introduction\n\nText here.\n\nThe Transfer Matrix\n\nmore text, of course.")
    rows = X.lines(h, "doc_id", "text")
    kinds = {r["line"]: r["k"] for r in rows.withColumn("k", X.heading_kind(F.col("line"), F.col("blank_before"), F.col("blank_after"))).collect()}
    assert kinds["1. Introduction"] == "numbered" and kinds["The Transfer Matrix"] == "shape" and kinds["Text here."] is None


def test_layers_of_text(spark):
    t = docs(spark, "trans-\nfer matrix and coun-\nting", "a­ b \r\nc")
    got = [r[0] for r in t.orderBy("doc_id").select(X.dehyphenated(X.conservative(F.col("text")))).collect()]
    assert got == ["transfer matrix and counting", "a b\nc"]


def test_expectation_and_status(spark):
    df = spark.createDataFrame([("book", "conclusion"), ("article", "abstract"), ("other", "abstract")], "w string, f string")
    assert [r[0] for r in df.select(X.expectation(F.col("w"), F.col("f"))).collect()] == ["not_applicable", "expected", "expected"]
    s = spark.createDataFrame([(0, 0), (2, 2), (1, 2), (0, 2)], "p int, a int")
    assert [r[0] for r in s.select(X.overall_status(F.col("p"), F.col("a"))).collect()] == ["not_applicable", "extracted", "partial", "manual_required"]


def test_tfidf(spark):
    d = docs(spark, "common lattice lattice", "common poset", "common", "", None)
    rows = T.tfidf(d, "doc_id", "text", stop=["poset"]).collect()
    first = {r["doc"]: r["term"] for r in rows if r["place"] == 1}
    assert first[0] == "lattice" and first[1] == "common" and not any(r["term"] == "poset" for r in rows)
    assert T.tfidf(d.limit(0), "doc_id", "text").count() == 0


def test_resolution(spark):
    works = spark.createDataFrame(
        [("w1", "Plane Partitions", 1971, ["R. Stanley"], {"doi": "10.1/AB"}), ("w2", "Plane partitions", 1980, ["X. Other"], None), ("w3", "Alone", 2000, ["A. Bee"], None), ("w4", None, None, None, None)],
        "work_id string, title string, year int, authors array<string>, identifiers map<string,string>",
    )
    refs = spark.createDataFrame(
        [
            (1, "doi:10.1/ab", None, "x", None, None), (2, None, None, "Plane partitions", 1971, ["Stanley, R."]), (3, None, None, "Plane partitions", None, None), (4, None, None, "Alone", 2000, ["Bee, A."]),
            (5, None, None, "alone", 1999, None), (6, "10.9999/none", None, None, None, None), (7, None, None, None, None, None), (4, None, None, "Alone", 2000, ["Bee, A."]),
        ],
        "ref_id int, doi string, isbn string, title string, year int, authors array<string>",
    )
    got = {r["ref_id"]: (r["status"], r["target_id"]) for r in RS.resolve(refs, works).collect()}
    assert got[2] == ("resolved", "w1") and got[4] == ("resolved", "w3") and got[3][0] == got[5][0] == "ambiguous"
    assert got[6] == ("discovered", "doi:10.9999/none") and got[7] == ("unresolved", None) and len(got) == 7


def test_rules(spark):
    w = spark.createDataFrame(
        [("w1", ["A"], " ", "present", "article", "verified", "open", {"doi": ""}), ("w2", ["A"], "T", "odd", "film", "unverified", "shut", {}), ("w3", [], "T", "unknown", "book", "verified", "open", None)],
        "work_id string, aliases array<string>, title string, title_status string, work_type string, metadata_status string, access_state string, identifiers map<string,string>",
    )
    got = {(r["code"], r["location"]) for r in V.corpus_issues(w).collect()}
    assert {("duplicate-alias", "A"), ("empty-title", "w1"), ("empty-identifier", "w1"), ("bad-title-status", "w2"), ("bad-work-type", "w2"), ("bad-access", "w2"), ("unverified-work", "w2"), ("missing-alias", "w3"), ("unverifiable-metadata", "w3")} == got
    assert not V.gate(V.corpus_issues(w)) and V.gate(V.corpus_issues(w.limit(0)))
    d = V.dangling(spark.createDataFrame([("a",), ("b",), (None,)], "k string"), "k", spark.createDataFrame([("a",)], "id string"), "error", "dangling-ref")
    assert [tuple(r) for r in d.collect()] == [("error", "dangling-ref", "b")]


def test_rights_and_leaks(spark):
    df = spark.createDataFrame([("title", True, False, False, None), ("abstract", True, True, False, None), ("abstract", True, True, False, "u"), ("fulltext", True, True, False, "u"), ("odd", True, True, True, "u")], "f string, m boolean, a boolean, t boolean, e string")
    got = [tuple(r[0]) for r in df.select(RT.clearance(*[F.col(c) for c in "fmate"])).collect()]
    assert [g[0] for g in got] == [True, False, True, False, False] and got[4][1] == "unknown field"
    leaks = spark.createDataFrame([("mail a.b@c.org",), ("api_key: abcdef123",), ("see /home/ann/x",), ("sk-abcdefghijklmnop1",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in leaks.select(RT.leak(F.col("t"))).collect()] == ["email", "key-value", "path", "token", None, None]
