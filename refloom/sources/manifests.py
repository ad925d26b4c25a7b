"""Scans of manifests: nested JSON, JSON lines, Markdown tables, word lists."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: The largest JSON file that is parsed, in bytes (fixed value).
MOST_BYTES = 64 << 20

ASSET = "struct<id: string, role: string, url: string, intent: string, expected_media_type: string, note: string, min_bytes: int>"
RIGHTS = "struct<access: string, license: string, license_evidence_url: string, local_storage_allowed: boolean, publish_metadata: boolean, publish_abstract: boolean, publish_fulltext: boolean>"
WORK = f"struct<id: string, aliases: array<string>, title: string, title_status: string, work_type: string, metadata_status: string, rights: {RIGHTS}, assets: array<{ASSET}>, authors: array<string>, year: int, container: string, members: array<string>, identifiers: map<string, string>, note: string>"
CORPUS = f"source struct<document: string, supplied: boolean, observed_on: string, expected_aliases: array<string>>, works array<{WORK}>"
DEPENDENCIES = "nodes array<struct<id: string, kind: string, label: string, ref: string, options: array<string>, note: string>>, edges array<struct<`from`: string, `to`: string, type: string, note: string>>"


class ManifestError(ValueError):
    """A manifest lacks what it must have."""


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document, refused beyond MOST_BYTES before it is parsed; a document of another shape raises."""
    local = path.removeprefix("file://")
    if os.path.exists(local) and os.path.getsize(local) > MOST_BYTES:
        raise ManifestError(f"{path} has more than {MOST_BYTES} bytes")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _required(rows: DataFrame, *names: str) -> DataFrame:
    for n in names:
        if not rows.where(F.col(n).isNull()).isEmpty():
            raise ManifestError(f"missing {n}")
    return rows


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Works with defaults for what may be left out; id and work_type must be there."""
    w = _required(read_json(spark, path, CORPUS).select(F.explode("works").alias("w")).select("w.*"), "id", "work_type")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    flag = lambda n, default: F.coalesce(F.col(f"rights.{n}"), F.lit(default)).alias(n)
    rights = F.struct(F.coalesce("rights.access", F.lit("unknown")).alias("access"), F.col("rights.license").alias("license"), F.col("rights.license_evidence_url").alias("license_evidence_url"), flag("local_storage_allowed", False), flag("publish_metadata", True), flag("publish_abstract", False), flag("publish_fulltext", False))
    return w.select(
        "id", empty("aliases", "array<string>").alias("aliases"), "title", F.coalesce("title_status", F.lit("unknown")).alias("title_status"), "work_type", F.coalesce("metadata_status", F.lit("unverified")).alias("metadata_status"),
        rights.alias("rights"), empty("assets", f"array<{ASSET}>").alias("assets"), empty("authors", "array<string>").alias("authors"), "year", "container", empty("members", "array<string>").alias("members"),
        F.coalesce("identifiers", F.create_map().cast("map<string,string>")).alias("identifiers"), "note",
    )


def assets(works: DataFrame) -> DataFrame:
    """One row for each asset; id, role and intent must be there."""
    return _required(works.select(F.col("id").alias("work_id"), F.explode("assets").alias("a")).select("work_id", "a.*"), "id", "role", "intent")


def read_dependencies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges); a node without a label has its id as one."""
    d = read_json(spark, path, DEPENDENCIES)
    nodes = d.select(F.explode("nodes").alias("n")).select("n.*").withColumn("label", F.coalesce("label", "id"))
    edges = d.select(F.explode("edges").alias("e")).select(F.col("e.from").alias("from_node"), F.col("e.to").alias("to_node"), F.col("e.type").alias("edge_type"), F.col("e.note").alias("note"))
    return nodes, edges


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """(choice_id, selected): selected is null for a choice that is left open."""
    return read_json(spark, path, "selections map<string, string>").select(F.explode("selections").alias("choice_id", "selected"))


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines without the header row and blank lines."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.json(path)
    return rows.where("_meta is null").drop("_meta") if "_meta" in rows.columns else rows


def read_words(spark: SparkSession, path: str) -> list[str]:
    """A list of words, one a line; a missing file is an empty list. The list is small by nature."""
    if not os.path.exists(path.removeprefix("file://")):
        return []
    return [r[0] for r in spark.read.text(path).where("trim(value) <> ''").select(F.trim("value")).collect()]


REQUIRED = ("id", "title", "type", "access", "url", "role", "intent")


def plain_cell(cell: Column) -> Column:
    """A table cell without Markdown emphasis, code marks and links."""
    return F.trim(F.regexp_replace(F.regexp_replace(cell, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"[*`_]{1,2}", ""))


def cell_url(cell: Column) -> Column:
    """The target of a Markdown link, else a bare URL without trailing punctuation; null without one."""
    link = F.regexp_extract(cell, r"\[[^\]]*\]\((\S+?)\)", 1)
    bare = F.regexp_replace(F.regexp_extract(cell, r"(https?://\S+)", 1), r"[.,;]+$", "")
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(bare, F.lit("")))


def media_type(url: Column) -> Column:
    """A guess by the suffix, query and fragment left out."""
    s = F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    return F.when(s.rlike(r"\.pdf$"), "application/pdf").when(s.rlike(r"\.(html?|xhtml)$|/$"), "text/html").when(s.rlike(r"\.xml$"), "application/xml").when(s.rlike(r"\.txt$"), "text/plain")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(pos, name of each column in lower case...): the rows of the first Markdown table with the required columns.

    The table ends at its first line that is no row. Raises ManifestError if there is none, naming the columns needed.
    """
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))
    cells = F.transform(F.split(F.regexp_replace(F.regexp_replace(F.trim("line"), r"^\|", ""), r"\|$", ""), r"(?<!\\)\|"), lambda c: F.trim(c))
    w = W.orderBy("pos")  # one document of at most a few thousand lines
    rows = lines.withColumn("is_row", F.trim("line").startswith("|")).withColumn("cells", cells).withColumn("next", F.lead("line").over(w)).withColumn("names", F.transform("cells", lambda c: F.lower(c)))
    heads = rows.where(F.col("is_row") & F.trim("next").rlike(r"^\|?(\s*:?-{2,}:?\s*\|?)+$") & (F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), "names")) == 0))
    head = heads.orderBy("pos").first()
    if head is None:
        raise ManifestError("no table with the columns " + ", ".join(REQUIRED))
    end = rows.where((F.col("pos") > head["pos"]) & ~F.col("is_row")).agg(F.min("pos")).first()[0]
    body = rows.where((F.col("pos") > head["pos"] + 1) & (F.lit(True) if end is None else F.col("pos") < end))
    return body.select("pos", *[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(head["names"]) if n])


def catalogue_works(rows: DataFrame) -> DataFrame:
    """One work for each alias: its first row defines it, every row with a URL gives an asset named alias-role-n."""
    w = W.partitionBy("alias").orderBy("pos")
    word = lambda c, default: F.coalesce(F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"[\s-]+", "_"), F.lit("")), F.lit(default))
    r = rows.withColumn("alias", plain_cell(F.col("id"))).withColumn("target", cell_url(F.col("url")))
    r = r.withColumn("n", F.count("target").over(w.rowsBetween(W.unboundedPreceding, 0)))
    asset = F.struct(F.concat_ws("-", "alias", word(F.col("role"), "landing"), "n").alias("id"), word(F.col("role"), "landing").alias("role"), F.col("target").alias("url"), word(F.col("intent"), "metadata_only").alias("intent"), media_type(F.col("target")).alias("expected_media_type"))
    first = lambda c: F.min_by(c, "pos")
    year = F.when(F.col("year").rlike(r"^\s*\d{4}\s*$"), F.trim("year").cast("int")) if "year" in rows.columns else F.lit(None).cast("int")
    authors = F.filter(F.transform(F.split(F.col("authors"), ";"), lambda a: F.trim(a)), lambda a: a != "") if "authors" in rows.columns else F.array().cast("array<string>")
    return r.groupBy("alias").agg(
        first(plain_cell(F.col("title"))).alias("title"), first(word(F.col("type"), "article")).alias("work_type"), first(word(F.col("access"), "unknown")).alias("access"), first(year).alias("year"), first(authors).alias("authors"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("pos", asset.alias("a"))))), lambda x: x["a"]).alias("assets"),
    )
