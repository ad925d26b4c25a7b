"""Scans of markup: HTML and JATS to text with blocks, links, plain text."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page, elements that end a run of text, elements without an end (fixed values).
DROPPED = frozenset("script style noscript nav header footer aside form button svg iframe template".split())
BLOCKS = frozenset("p div section article main ul ol li h1 h2 h3 h4 h5 h6 table tr td th blockquote pre figure figcaption dl dt dd address body html".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = "struct<kind: string, text: string, level: int, start: int, end: int, container: string>"
PARSED = f"text string, blocks array<{BLOCK}>, meta map<string, array<string>>, title_tag string"


class _Page(HTMLParser):
    """Collects runs of text between block elements. A run belongs to the elements that were open when it began."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None]] = []
        self.blocks: list[dict] = []
        self.meta: dict[str, list[str]] = {}
        self.links: list[str] = []
        self.ids: list[str] = []
        self.title: str | None = None
        self.run: list[str] = []
        self.size = 0

    def _end_run(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.run)).strip()
        self.run = []
        if not text:
            return
        tags = [t for t, _ in self.open]
        heading = next((t for t in reversed(tags) if re.fullmatch(r"h[1-6]", t)), None)
        kind = "heading" if heading else "list_item" if "li" in tags else "text"
        container = next((c for _, c in reversed(self.open) if c), None)
        start = self.size + (1 if self.blocks else 0)
        self.blocks.append({"kind": kind, "text": text, "level": int(heading[1]) if heading else 0, "start": start, "end": start + len(text), "container": container})
        self.size = start + len(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (name := a.get("name") or a.get("property")) and "content" in a:
            self.meta.setdefault(name.lower(), []).append(a["content"])
        if tag == "a" and "href" in a:
            self.links.append(a["href"])
        if "id" in a:
            self.ids.append(a["id"])
        if tag in VOID:
            if tag == "br":
                self.run.append(" ")
            return
        if tag in BLOCKS or tag in DROPPED:
            self._end_run()
        self.open.append((tag, a.get("class") or a.get("id") or None))

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _ in self.open):
            return
        if tag in BLOCKS or tag in DROPPED:
            self._end_run()
        while self.open.pop()[0] != tag:
            pass

    def handle_data(self, data: str) -> None:
        tags = {t for t, _ in self.open}
        if "title" in tags and not self.blocks:
            self.title = (self.title or "") + data
        elif not tags & DROPPED and "head" not in tags:
            self.run.append(data)

    def close(self) -> None:
        super().close()
        self._end_run()


def parse_html(source: str) -> dict:
    """text, blocks (whose spans cut their text out of text), meta, title_tag, links and ids of a page; never raises."""
    page = _Page()
    page.feed(source)
    page.close()
    return {"text": "\n".join(b["text"] for b in page.blocks), "blocks": page.blocks, "meta": page.meta, "title_tag": page.title.strip() if page.title else None, "links": page.links, "ids": page.ids}


def parse_jats(source: str) -> dict | None:
    """As parse_html for a JATS article; None for what is no XML or no article."""
    try:
        root = ET.fromstring(source)
    except ET.ParseError:
        return None
    local = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
    if local(root) != "article":
        return None
    blocks: list[dict] = []
    size = 0

    def emit(kind: str, element: ET.Element, level: int, container: str | None) -> None:
        nonlocal size
        text = re.sub(r"\s+", " ", "".join(element.itertext())).strip()
        if text:
            start = size + (1 if blocks else 0)
            blocks.append({"kind": kind, "text": text, "level": level, "start": start, "end": start + len(text), "container": container})
            size = start + len(text)

    def walk(element: ET.Element, level: int, container: str | None) -> None:
        for child in element:
            name = local(child)
            if name == "title":
                emit("heading", child, level, container)
            elif name == "p":
                emit("text", child, 0, container)
            elif name == "ref":
                emit("list_item", child, 0, "references")
            else:
                walk(child, level + (name == "sec"), {"abstract": "abstract", "ref-list": "references"}.get(name, container))

    meta: dict[str, list[str]] = {}
    for e in root.iter():
        if local(e) == "article-title" and "citation_title" not in meta:
            meta["citation_title"] = [re.sub(r"\s+", " ", "".join(e.itertext())).strip()]
    walk(root, 1, None)
    return {"text": "\n".join(b["text"] for b in blocks), "blocks": blocks, "meta": meta, "title_tag": None, "links": [], "ids": []}


def parsed_pages(pages: DataFrame, page_id: str, source: str) -> DataFrame:
    """(page_id, text, blocks, meta, title_tag): JATS where the source is an article, else HTML. Null sources give no row."""
    key = pages.schema[page_id].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [parse_jats(s) or parse_html(s) for s in pdf["source"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], **{k: [r[k] for r in rows] for k in ("text", "blocks", "meta", "title_tag")}})

    return pages.select(F.col(page_id).alias("page_id"), F.col(source).alias("source")).where("source is not null").mapInPandas(run, f"page_id {key}, {PARSED}")


def page_links(pages: DataFrame, page_id: str, source: str) -> DataFrame:
    """(page_id, link, kind): every link of a page; kind is external, anchor, absolute, mail or relative."""
    key = pages.schema[page_id].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame([(p, x) for p, s in zip(pdf["page_id"], pdf["source"], strict=True) for x in parse_html(s)["links"]], columns=["page_id", "link"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(source).alias("source")).where("source is not null").mapInPandas(run, f"page_id {key}, link string")
    x = F.col("link")
    kind = F.when(x.rlike("^(?i)https?://"), "external").when(x.rlike("^#"), "anchor").when(x.rlike("^(?i)mailto:"), "mail").when(x.rlike("^(?i)[a-z][a-z0-9+.-]*:"), "bad-scheme").when(x.startswith("/"), "absolute").otherwise("relative")
    return rows.withColumn("kind", kind)


def broken_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """Relative links whose page, or index.html below it, is not among `files` (path). Anchors and queries are left out."""
    rel = links.where("kind = 'relative'").withColumn("path", F.regexp_replace(F.regexp_replace("link", r"[#?].*$", ""), r"/$", "/index.html"))
    known = files.select("path").distinct()
    index = known.where(F.col("path").endswith("/index.html")).select(F.regexp_replace("path", r"/index\.html$", "").alias("path"))
    return rel.join(known.unionByName(index).distinct(), "path", "left_anti").select("page_id", "link")


def sniffed(head) -> object:
    """The media type by the first bytes of a text; null if they tell nothing."""
    h = F.lower(F.substring(head, 1, 256))
    return F.when(F.startswith(head, F.lit("%PDF-")), "application/pdf").when(h.contains("<!doctype html") | h.contains("<html"), "text/html").when(F.startswith(F.ltrim(h), F.lit("<?xml")), "application/xml")


def page_count(text) -> object:
    """Pages of a text with form feeds."""
    return F.size(F.split(text, "\f", -1))
