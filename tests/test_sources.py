import json

import pytest
from pyspark.sql import functions as F

from refloom.sources import manifests as M
from refloom.sources import markup as U
from refloom.sources import sinks as K

PAGE = """<html><head><title> A page </title><meta name="citation_title" content="T"><meta name="citation_author" content="A"><meta name="citation_author" content="B"></head>
<body><nav>menu</nav><script>x()</script><h1>Main &amp; more</h1><section class="abstract"><h2>Abstract</h2><p>Some <b>bold</b> text<br>here.</p></section>
<ol class="references"><li><p>First</p></li><li>Second <a href="b.html#x">link</a></li></ol><p id="x">Loose<div class="y">Inner</div></body></html>"""


def test_html(spark):
    p = U.parse_html(PAGE)
    assert all(p["text"][b["start"] : b["end"]] == b["text"] for b in p["blocks"])
    assert [(b["kind"], b["text"], b["level"], b["container"]) for b in p["blocks"]] == [
        ("heading", "Main & more", 1, None), ("heading", "Abstract", 2, "abstract"), ("text", "Some bold text here.", 0, "abstract"), ("list_item", "First", 0, "references"), ("list_item", "Second link", 0, "references"), ("text", "Loose", 0, "x"), ("text", "Inner", 0, "y"),
    ]
    assert p["meta"] == {"citation_title": ["T"], "citation_author": ["A", "B"]} and p["title_tag"] == "A page"
    U.parse_html("<p>unclosed <b> </i> <<x")
    rows = U.parsed_pages(spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "id int, html string"), "id", "html").collect()
    assert {r["page_id"]: len(r["blocks"]) for r in rows} == {1: 7, 2: 0}


def test_jats():
    j = "<article><front><article-meta><title-group><article-title>A <i>b</i></article-title></title-group><abstract><p>Abs</p></abstract></article-meta></front><body><sec><title>One</title><p>P</p></sec></body><back><ref-list><ref>R1</ref></ref-list></back></article>"
    p = U.parse_jats(j)
    assert p["meta"]["citation_title"] == ["A b"] and [(b["kind"], b["container"]) for b in p["blocks"]] == [("text", "abstract"), ("heading", None), ("text", None), ("list_item", "references")]
    assert U.parse_jats("<html/>") is None and U.parse_jats("no xml") is None


def test_links(spark):
    pages = spark.createDataFrame([("a", '<a href="b.html#x">1</a><a href="http://x">2</a><a href="#y">3</a><a href="/z">4</a><a href="gone.html">5</a><a href="javascript:x">6</a><a href="dir/">7</a>')], "id string, html string")
    links = U.page_links(pages, "id", "html")
    assert [r["kind"] for r in links.collect()] == ["relative", "external", "anchor", "absolute", "relative", "bad-scheme", "relative"]
    files = spark.createDataFrame([("b.html",), ("dir/index.html",)], "path string")
    assert [r["link"] for r in U.broken_links(links, files).collect()] == ["gone.html"]


def test_sniffed(spark):
    df = spark.createDataFrame([("%PDF-1.4",), ("<!DOCTYPE html><p>",), ("<?xml?>",), ("plain",)], "t string")
    assert [r[0] for r in df.select(U.sniffed(F.col("t"))).collect()] == ["application/pdf", "text/html", "application/xml", None]


def test_corpus_manifest(spark, tmp_path):
    work = {"id": "w1", "work_type": "article", "aliases": ["A1"], "assets": [{"id": "a", "role": "fulltext", "intent": "required", "url": "https://x"}], "rights": {"access": "open"}}
    p = tmp_path / "corpus.json"
    p.write_text(json.dumps({"source": {"document": "d"}, "works": [work, {"id": "w2", "work_type": "book"}]}))
    w = {r["id"]: r for r in M.read_corpus(spark, str(p)).collect()}
    assert w["w1"]["rights"]["access"] == "open" and w["w2"]["rights"]["publish_metadata"] and w["w2"]["aliases"] == [] and w["w2"]["title_status"] == "unknown"
    assert M.assets(M.read_corpus(spark, str(p))).count() == 1
    p.write_text(json.dumps({"works": [{"title": "no id"}]}))
    with pytest.raises(M.ManifestError, match="missing id"):
        M.read_corpus(spark, str(p))


def test_dependencies_profile_lines_words(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"nodes": [{"id": "n", "kind": "work"}], "edges": [{"from": "a", "to": "b", "type": "backup"}]}))
    nodes, edges = M.read_dependencies(spark, str(tmp_path / "d.json"))
    assert nodes.first()["label"] == "n" and tuple(edges.first())[:3] == ("a", "b", "backup")
    (tmp_path / "p.json").write_text(json.dumps({"selections": {"c1": "x", "c2": None}}))
    assert sorted(map(tuple, M.read_profile(spark, str(tmp_path / "p.json")).collect())) == [("c1", "x"), ("c2", None)]
    (tmp_path / "r.jsonl").write_text('{"_meta": {"v": 1}}\n\n{"a": 1}\n{"a": 2}\n')
    assert sorted(r["a"] for r in M.read_jsonl(spark, str(tmp_path / "r.jsonl")).collect()) == [1, 2]
    (tmp_path / "w.txt").write_text("a\n\n the \n")
    assert M.read_words(spark, str(tmp_path / "w.txt")) == ["a", "the"] and M.read_words(spark, str(tmp_path / "none.txt")) == []


def test_catalogue(spark, tmp_path):
    p = tmp_path / "c.md"
    p.write_text("text\n\n| ID | Title | Type | Access | URL | Role | Intent | Authors | Year |\n|---|---|:--:|---|---|---|---|---|---|\n| R0 | **A** Survey | Article | open | [x](https://x.org/a.pdf) | Full-text | required | Ada; Bo | 2019 |\n| R0 | A Survey | article | open | https://x.org/b. | landing | metadata only | | n.d. |\n| A1 | `T` | book | | none | | | | 20 |\n\nafter | x |\n")
    works = {r["alias"]: r for r in M.catalogue_works(M.read_catalogue(spark, str(p))).collect()}
    assert works["R0"]["title"] == "A Survey" and works["R0"]["year"] == 2019 and works["R0"]["authors"] == ["Ada", "Bo"]
    assert [(a["id"], a["url"], a["intent"], a["expected_media_type"]) for a in works["R0"]["assets"]] == [("R0-full_text-1", "https://x.org/a.pdf", "required", "application/pdf"), ("R0-landing-2", "https://x.org/b", "metadata_only", None)]
    assert works["A1"]["assets"] == [] and works["A1"]["access"] == "unknown" and works["A1"]["year"] is None
    p.write_text("| ID | Title |\n|---|---|\n")
    with pytest.raises(M.ManifestError, match="role"):
        M.read_catalogue(spark, str(p))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "t1"), ("b", 2, "t2")], "k string, v int, run_id string")
    h = [r[0] for r in df.select(K.content_hash(df)).collect()]
    again = df.withColumn("run_id", F.lit("other")).select("v", "run_id", "k")
    assert h == [r[0] for r in again.select(K.content_hash(again)).collect()] and len(set(h)) == 2
    K.export({"works": df}, str(tmp_path), "test", {"in": "abc"})
    assert spark.read.parquet(str(tmp_path / "works")).count() == 2 and spark.read.json(str(tmp_path / "_meta/works")).first()["command"] == "test"
    K.append(df, str(tmp_path / "log"))
    K.append(df.withColumn("v", F.col("v") + 10), str(tmp_path / "log"))
    assert sorted(r["v"] for r in K.upserted(spark.read.parquet(str(tmp_path / "log")), "k", "v").collect()) == [11, 12]
    lines, text = K.report(df, "Summary", most=1)
    assert len(lines) == 1 and "first 1 rows" in text
