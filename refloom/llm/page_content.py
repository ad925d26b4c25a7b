"""Main content of pages: composite text density over a page's tree.

A page's blocks form a tree: the page, the title's section, the sections below headings, the lists under minor ones, the
blocks. Every node has characters, tags (blocks) and the characters and tags of links. Its composite density is

    C / T * log_b(C T / (LC LT)),    b = ln(C LC / (C - LC) + LCb C / Cb + e),

with LCb and Cb those of the body; it is zero for pure links and high for running text. The subtree with the largest sum
of its children's densities is the core. A node's retained density is its composite density over the one it would
have without links; the least retained density on the path from the core to the body is the page's threshold, and
subtrees and blocks that retain less are no content. Containers are opaque or misleading too often, so they are not used.

The tables keep no anchors, so the share of links in a block is estimated from structure and repetition, not from lists
of phrases: a naive Bayes model of words, marks and form is fitted on each collection anew. Wordings that recur over the
collection's pages (digits, names and hyphenated words masked) are taken for links and controls, unrepeated blocks of the titles'
sections, bylines and upper headings for content. Bars of parts between separators, and items of a list that end without
a full stop, are links whatever their words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.functions.text import fold
from refloom.plans.materialize import cut
from refloom.sources.tables import table

#: A wording recurs if it makes up more than one part in so many of all blocks, and so many blocks at least: so there are fewer than that many.
PARTS, LEAST = 10_000, 3
#: The model is fitted on a sample of about so many blocks that do not recur.
SAMPLE = 20_000
#: What retains less than this is no content on any page, however full of links the page is.
FLOOR = 0.12
#: Smoothing of the model's counts, and bounds of one feature's log ratio.
SMOOTH, LOW, HIGH = 0.3, -3.0, 4.0

_WORD = re.compile(r"[^\W\d_]{3,}")
_MARK = re.compile(r"[·©‹›«»>|@/]")
_SEPARATOR = re.compile(r"\s[|·>»/]\s|^\s*[‹«<]|[›»>]\s*$|\s{2,}")
#: Small words inside names (fixed values).
_PARTICLES = frozenset("van von der den de del della di da du la le les ten ter zu zur al el of for on at the and und et y für".split())


def features(text: str) -> set[str]:
    """Words, marks, how the text ends, how many words and sentences it has."""
    f = fold(text).strip()
    words = _WORD.findall(f)
    end = "." if f[-1:] == "." else "w" if f[-1:].isalnum() else "o"
    return {*words, *_MARK.findall(f), "$" + end, f"#{min(6, len(words).bit_length())}", f"!{min(3, f.count('. '))}"}


def names_only(text: str) -> bool:
    """Two or more words, all capitalised but for particles: as a line of authors is."""
    words = [w for w in re.split(r"[\s,;&]+", text) if w]
    return len(words) > 1 and all(w in _PARTICLES or any(p[:1].isupper() for p in re.split(r"[-'’]", w)) for w in words)


def is_bar(text: str) -> bool:
    """Parts between separators, none of them a sentence, as links stand in a row."""
    s = text.strip()
    if len(s) >= 400 or not _SEPARATOR.search(s):
        return False
    parts = [p.strip() for p in _SEPARATOR.split(s) if p.strip()]
    return len(parts) > 1 and not any(p.endswith(".") for p in parts) and any(_WORD.search(p) for p in parts)


def fit(recurring: list[str], content: list[str]) -> dict[str, float]:
    """The log ratio of each feature between recurring wordings and content."""
    pos = Counter(f for t in recurring for f in features(t))
    neg = Counter(f for t in content for f in features(t))
    a, b = len(recurring) + 2 * SMOOTH, len(content) + 2 * SMOOTH
    return {f: min(HIGH, max(LOW, math.log((pos[f] + SMOOTH) / a) - math.log((neg[f] + SMOOTH) / b))) for f in pos.keys() | neg.keys()}


def link_share(kind: str | None, level: int, text: str, byline: bool, model: dict[str, float]) -> float:
    """How much of a block reads as links or controls, from 0 to 1."""
    s = text.strip()
    if not s:
        return 1.0
    if kind == "heading" and level <= 2:
        return 0.0
    if byline and names_only(s):
        return 0.0
    # an item without a full stop and a bar are anchors by their form
    formal = 0.9 if (kind == "list_item" and not s.endswith(".")) or is_bar(s) else 0.0
    if not _WORD.search(s):
        return formal
    known = {f: model[f] for f in features(s) if f in model}
    # form alone makes no link: a word or mark must be one that recurring wordings use
    if not any(v > 0 and f[0] not in "$#!" for f, v in known.items()):
        return formal
    z = sum(known.values())
    return max(formal, 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def density(c: float, t: float, lc: float, lt: float, body_c: float, body_lc: float) -> float:
    """Composite text density of a node with c characters in t tags, lc of them in lt links."""
    if c <= 0 or t <= 0:
        return 0.0
    lc, lt = max(lc, 1.0), max(lt, 1.0)
    base = math.log(c / max(c - lc, 1.0) * lc + (body_lc / max(body_c, 1.0)) * c + math.e)
    return max(0.0, c / t * math.log(max(c * t / (lc * lt), 1.0)) / math.log(max(base, 1.0001)))


class Node:
    """A subtree: the half-open range of its blocks, and its children in order; a block has none."""

    def __init__(self, lo: int, hi: int, children: list[Node]) -> None:
        self.lo, self.hi, self.children = lo, hi, children


def _level(block: dict) -> int:
    return (block["heading_level"] or 2) if block["kind"] == "heading" else 99


def tree(blocks: list[dict]) -> Node:
    """The page's tree. A heading opens a section that ends at the next heading of its level or above.

    A minor heading's (level 3 on) section with a list ends with the list. Levels that are missing count as 2.
    """
    n = len(blocks)
    root = Node(0, n, [])
    stack: list[tuple[int, Node]] = [(0, root)]
    for i in range(n):
        own = _level(blocks[i])
        if own < 99:
            while stack[-1][0] >= own:
                stack.pop()[1].hi = i
            section = Node(i, n, [])
            stack[-1][1].children.append(section)
            stack.append((own, section))
        elif stack[-1][0] >= 3 and blocks[i]["kind"] != "list_item" and blocks[i - 1]["kind"] == "list_item":
            stack.pop()[1].hi = i
        stack[-1][1].children.append(Node(i, i + 1, []))
    while stack:
        stack.pop()[1].hi = n
    return root


def judge(blocks: list[dict], model: dict[str, float]) -> list[tuple[int, str | None, float, float, bool]]:
    """(block_no, container, link share, density, kept) of one page's blocks, in order."""
    top = next((i for i, b in enumerate(blocks) if b["kind"] == "heading" and b["heading_level"] == 1), None)
    chars = [float(len("".join((b["text"] or "").split()))) for b in blocks]
    links = [link_share(b["kind"], b["heading_level"] or 2, b["text"] or "", top is not None and i == top + 1, model) for i, b in enumerate(blocks)]
    # running sums, so that a node costs the same whatever it holds
    c_sum, lc_sum, lt_sum = [0.0], [0.0], [0.0]
    for c, s in zip(chars, links, strict=True):
        c_sum.append(c_sum[-1] + c)
        lc_sum.append(lc_sum[-1] + c * s)
        lt_sum.append(lt_sum[-1] + s)
    body = c_sum[-1], lc_sum[-1]

    def dense(node: Node, linked: bool = True) -> float:
        lo, hi = node.lo, node.hi
        lc, lt = (lc_sum[hi] - lc_sum[lo], lt_sum[hi] - lt_sum[lo]) if linked else (0.0, 0.0)
        return density(c_sum[hi] - c_sum[lo], hi - lo, lc, lt, *body)

    def retained(node: Node) -> float:
        plain = dense(node, False)
        # a node of one or two characters has no density to lose
        return dense(node) / plain if plain > 0 else 1.0 - (lc_sum[node.hi] - lc_sum[node.lo]) / max(c_sum[node.hi] - c_sum[node.lo], 1.0)

    root = tree(blocks)
    best, path = (-1.0, 0, []), []
    todo = [(root, [root])]
    while todo:
        node, path = todo.pop()
        if node.children:
            best = max(best, (sum(dense(c) for c in node.children), node.hi - node.lo, path), key=lambda x: x[:2])
            todo += [(c, [*path, c]) for c in node.children]
    threshold = max(FLOOR, min((retained(node) for node in best[2]), default=0.0))
    kept = [False] * len(blocks)
    todo = [root]
    while todo:
        node = todo.pop()
        # an upper heading's section runs on to the page's end, so it may hold a footer and is judged block by block
        if (not node.children or 3 <= _level(blocks[node.lo]) < 99) and retained(node) < threshold:
            continue
        if node.children:
            todo += node.children
        else:
            # a block without a word or sign of its own is never content
            kept[node.lo] = chars[node.lo] > 0
    # what comes before the title belongs to the page, not to the work
    if top is not None:
        kept[:top] = [False] * top
    return [(b["block_no"], b["container"], s, dense(Node(i, i + 1, [])), k) for i, (b, s, k) in enumerate(zip(blocks, links, kept, strict=True))]


def wording(text: Column) -> Column:
    """The text with numbers, hyphenated words and capitalised words after the first masked, in lower case."""
    s = F.regexp_replace(text, r"\d+", "#")
    s = F.regexp_replace(s, r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)+", "@")
    return F.lower(F.regexp_replace(s, r"(?<=.)(?<![\p{L}\p{N}])\p{Lu}[\p{L}\p{N}'’.]*", "@"))


def fitted(pages: DataFrame, parts: int = PARTS, sample: int = SAMPLE) -> dict[str, float]:
    """The model of this collection. `pages` has page_id, top (the place of the title's heading or null) and blocks.

    All blocks are counted by wording, combined before their exchange. Recurring wordings are fewer than `parts` or so
    (see PARTS), whatever the collection's size, and the unrepeated blocks are a sample of about `sample`, so what comes
    to the driver is bounded.
    """
    b = pages.select("page_id", "top", F.posexplode("blocks").alias("at", "b")).select("page_id", "top", "at", "b.kind", "b.text", F.coalesce("b.heading_level", F.lit(2)).alias("level"))
    b = b.where("trim(text) <> ''").withColumn("wording", F.xxhash64(wording(F.col("text"))))
    upper = F.coalesce((F.col("kind") == "heading") & (F.col("level") <= 2), F.lit(False))
    entry = F.coalesce((F.col("kind") == "list_item") & F.rtrim("text").endswith("."), F.lit(False))
    byline = F.coalesce((F.col("at") == F.col("top") + 1) & (F.col("kind") == "text"), F.lit(False))
    b = b.select("page_id", "at", "text", "wording", upper.alias("upper"), entry.alias("entry"), byline.alias("byline"), F.coalesce((F.col("at") > F.col("top")) & (F.col("kind") == "text"), F.lit(False)).alias("inside"))
    counts = b.groupBy("wording").agg(F.count("*").alias("n"), F.min(F.when(~(F.col("upper") | F.col("entry")), F.struct(F.length("text").alias("l"), F.substring("text", 1, 2000).alias("t")))).alias("m"))
    n = pages.agg(F.sum(F.size("blocks"))).first()[0] or 0
    often = cut(counts.where(F.col("n") >= max(LEAST, n / parts)).select("wording", F.col("m.t").alias("text")))
    few = b.where(F.pmod(F.xxhash64("page_id", "at", F.lit(7)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / max(1, n)))))
    few = few.join(F.broadcast(often.select("wording", F.lit(True).alias("often"))), "wording", "left")
    content = few.where("upper or byline or ((inside or entry) and often is null)").select("text").collect()
    recurring = [r["text"] for r in often.where("text is not null").collect()]
    return fit([t for t in recurring if not names_only(t)], [r["text"] for r in content])


def _judged(model):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for page, blocks in zip(pdf["page_id"], pdf["blocks"], strict=True):
                out += [(page, *r) for r in judge(list(blocks), model.value)]
            yield pd.DataFrame(out, columns=["page_id", "block_no", "container", "link_share", "density", "kept"])

    return run


def page_blocks(blocks: DataFrame, model: dict[str, float] | None = None) -> DataFrame:
    """(page_id, block_no, container, link_share, density, kept) for every block; the model is fitted unless one is given.

    Needs page_id, block_no, kind, text, heading_level, container. A null text counts as empty and is never content,
    null kinds and containers say nothing, of repeated rows of a block one counts. Blocks of equal block_no keep no
    particular order. Pages without blocks give no row; a page is judged whole, whatever its length.
    """
    cols = blocks.select("page_id", "block_no", "kind", "text", "heading_level", "container").where("page_id is not null and block_no is not null")
    fields = ["block_no", "kind", "text", "heading_level", "container"]
    pages = cols.groupBy("page_id").agg(F.array_sort(F.collect_set(F.struct(*fields))).alias("blocks"))
    title = F.transform("blocks", lambda b: F.coalesce((b["kind"] == "heading") & (b["heading_level"] == 1), F.lit(False)))
    pages = cut(pages.withColumn("top", F.array_position(title, True) - 1).withColumn("top", F.when(F.col("top") >= 0, F.col("top"))))
    shared = blocks.sparkSession.sparkContext.broadcast(fitted(pages) if model is None else model)
    key = blocks.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "blocks").mapInPandas(_judged(shared), f"page_id {key}, block_no int, container string, link_share double, density double, kept boolean")
def furniture(blocks: DataFrame) -> DataFrame:
    """(page_id, block_no): what is not the page's own content."""
    return page_blocks(blocks).where("not kept").select("page_id", "block_no")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_blocks", "page_id", "block_no", "kind", "text", "heading_level", "container")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return furniture(_blocks(spark, d))


def p7_main_text(spark: SparkSession, d: str) -> DataFrame:
    """Each page's remaining text, cut out of parsed_html.text by the spans of its blocks, and its share of the page."""
    kept = page_blocks(_blocks(spark, d)).where("kept").select("page_id", "block_no")
    spans = table(spark, d, "page_blocks", "page_id", "block_no", "start_char", "end_char").join(kept, ["page_id", "block_no"])
    per = spans.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("block_no", "start_char", "end_char"))).alias("spans"))
    pages = table(spark, d, "parsed_html", "page_id", "text")
    text = F.array_join(F.transform("spans", lambda s: F.substring(F.col("text"), s["start_char"] + 1, s["end_char"] - s["start_char"])), "\n")
    out = pages.join(per, "page_id", "left").withColumn("main_text", F.coalesce(text, F.lit("")))
    return out.select("page_id", "main_text", F.round(F.length("main_text") / F.greatest(F.length("text"), F.lit(1)), 6).alias("share"))


def queries() -> dict:
    return {"p7_found": p7_found, "p7_main_text": p7_main_text}


def oracle_sql() -> dict[str, str]:
    return {}
