"""Discriminating terms of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions.bibliographic import match_key
from refloom.plans.materialize import cut
from refloom.plans.skew import heavy_keys, lookup

TOKEN = r"[a-z][a-z0-9'-]{2,}"


def tokens(text, stop: list[str] | None = None):
    """The words of a text in match form, repeats kept, without stop words."""
    found = F.regexp_extract_all(match_key(text), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop)) if stop else found


def tfidf(docs: DataFrame, doc: str, text: str, n: int = 12, stop: list[str] | None = None) -> DataFrame:
    """(doc, place, term, score): the n best terms of each document.

    tf = 0.5 + 0.5 c / max c, idf = ln((1 + N) / (1 + df)), score = tf idf + 1e-9, ordered by unrounded score and term. N counts
    documents without terms too. Terms are counted where their document lies; df comes back by a lookup that scatters
    the terms which hold over a thousandth of the rows.
    """
    one = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("doc is not null").dropDuplicates(["doc"])
    total = one.count()
    rows = one.select("doc", F.explode(tokens(F.col("text"), stop)).alias("term")).groupBy("doc", "term").agg(F.count("*").alias("c"))
    rows = cut(rows.withColumn("most", F.max("c").over(W.partitionBy("doc"))))
    df = cut(rows.groupBy("term").agg(F.count("*").alias("df")))
    joined = lookup(rows, df, "term", heavy_keys(df, "term", "df", rows.count()))
    score = (0.5 + 0.5 * F.col("c") / F.col("most")) * F.ln(F.lit(1.0 + total) / (1 + F.col("df"))) + F.lit(1e-9)
    place = F.row_number().over(W.partitionBy("doc").orderBy(F.desc("score"), "term"))
    return joined.withColumn("score", score).withColumn("place", place).where(F.col("place") <= n).select("doc", "place", "term", F.round("score", 6).alias("score"))


def cluster_terms(members: DataFrame, titles: DataFrame, n: int = 12, stop: list[str] | None = None) -> DataFrame:
    """(component, place, term, score): each cluster's best terms, its members' titles being its document.

    Titles are counted per cluster after one exchange; a cluster's text is never put together in one row.
    """
    t = members.join(titles, "node").select("component", F.explode(tokens(F.col("title"), stop)).alias("term"))
    rows = cut(t.groupBy("component", "term").agg(F.count("*").alias("c")).withColumn("most", F.max("c").over(W.partitionBy("component"))))
    total = members.select("component").distinct().count()
    df = rows.groupBy("term").agg(F.count("*").alias("df"))
    score = (0.5 + 0.5 * F.col("c") / F.col("most")) * F.ln(F.lit(1.0 + total) / (1 + F.col("df"))) + F.lit(1e-9)
    place = F.row_number().over(W.partitionBy("component").orderBy(F.desc("score"), "term"))
    return rows.join(df, "term").withColumn("score", score).withColumn("place", place).where(F.col("place") <= n).select("component", "place", "term", F.round("score", 6).alias("score"))
