"""Fields located in pages with their provenance: title, abstract, introduction, conclusion, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions.bibliographic import citation_metadata
from refloom.operators.extract import ROLES, role


def titles(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page_id, title, method, confidence): from the page's metadata, else its first heading, else its first line."""
    first = blocks.where("kind = 'heading'").groupBy("page_id").agg(F.min_by("text", "block_no").alias("heading"))
    p = pages.select("page_id", citation_metadata(F.col("meta"))["title"].alias("meta_title"), F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 200).alias("line"))
    p = p.join(first, "page_id", "left")
    pick = lambda a, b, c: F.when(F.col("meta_title").isNotNull(), a).when(F.col("heading").isNotNull(), b).when(F.length("line") > 0, c)
    return p.select("page_id", pick(F.col("meta_title"), F.col("heading"), F.col("line")).alias("title"), pick(F.lit("metadata"), F.lit("heading"), F.lit("first-line")).alias("method"), pick(F.lit(0.98), F.lit(0.95), F.lit(0.45)).alias("confidence"))


def roles(blocks: DataFrame) -> DataFrame:
    """(page_id, role, text, method, confidence, start_char, end_char) for each role that is found.

    The first text block of a container named for the role, else the first heading of that role with the blocks up to
    the next heading. Blocks are walked within their page.
    """
    b = blocks.select("page_id", "block_no", "kind", "text", "container", "start_char", "end_char")
    inside = b.where("kind = 'text' and container is not null").withColumn("role", F.coalesce(*[F.when(F.lower("container").contains(r), r) for r in ROLES])).where("role is not null")
    span = F.struct("text", "start_char", "end_char")
    by_box = inside.groupBy("page_id", "role").agg(F.min_by(span, "block_no").alias("s")).select("page_id", "role", "s.*", F.lit("container").alias("method"), F.lit(0.9).alias("confidence"))
    w = W.partitionBy("page_id").orderBy("block_no")
    section = F.sum(F.when(F.col("kind") == "heading", 1).otherwise(0)).over(w)
    walked = b.withColumn("section", section)
    heads = walked.where("kind = 'heading'").select("page_id", "section", role(F.col("text")).alias("role")).where("role is not null")
    body = walked.where("kind <> 'heading'").join(heads, ["page_id", "section"]).groupBy("page_id", "section", "role").agg(F.array_sort(F.collect_list(F.struct("block_no", "text", "start_char", "end_char"))).alias("bs"))
    by_head = body.groupBy("page_id", "role").agg(F.min_by("bs", "section").alias("bs")).select("page_id", "role", F.array_join(F.transform("bs", lambda x: x["text"]), "\n").alias("text"), F.array_min(F.transform("bs", lambda x: x["start_char"])).alias("start_char"), F.array_max(F.transform("bs", lambda x: x["end_char"])).alias("end_char"), F.lit("heading").alias("method"), F.lit(0.95).alias("confidence"))
    rest = by_head.join(by_box.select("page_id", "role"), ["page_id", "role"], "left_anti")
    return by_box.unionByName(rest)
