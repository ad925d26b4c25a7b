"""All similar pairs between set-valued records: an adaptive extended-prefix join.

Two sets whose Jaccard similarity is at least t share, in a common order of tokens, their first common token within
the first |x| - ceil(t |x|) + 1 tokens of either, and their k-th common token within the first
|x| - ceil(t |x|) + k. So a pair can be found by one prefix token, or by two tokens of prefixes one longer, and so on:
longer prefixes cost more signatures and give fewer candidates. Each signature is extended by a further token exactly
where it is still shared by too many sets, which both sides of any pair see alike, so no pair is lost. Tokens are
ordered by rarity. Equal sets are joined once and stand for all their records.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.plans.materialize import cut
from refloom.plans.skew import heavy_keys, lookup
from refloom.sources.tables import table

#: A signature that more sets than this share is extended by a token.
CROWD = 40
#: Most tokens in a signature.
DEPTH = 4


def _clean(rows: DataFrame, record: str, value: str) -> DataFrame:
    cols = rows.select(F.col(record).cast("string").alias("record"), F.lower(F.regexp_replace(F.col(value).cast("string"), r"^\s+|\s+$", "")).alias("token"))
    return cols.where("record is not null and token is not null").distinct()


def set_classes(rows: DataFrame, record: str, value: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(class_id, tokens, size) and (record, class_id) of the sets with at least `least` tokens.

    A class is a set of tokens, ordered from the rarest, and its id its smallest record. The token counts come back by
    a lookup that scatters the tokens which hold over a thousandth of the rows.
    """
    pairs = cut(_clean(rows, record, value))
    counts = cut(pairs.groupBy("token").agg(F.count("*").alias("n")))
    ranked = lookup(pairs, counts, "token", heavy_keys(counts, "token", "n", pairs.count()))
    sets = ranked.groupBy("record").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("a")).where(F.size("a") >= least)
    sets = cut(sets.select("record", F.col("a.token").alias("tokens")).withColumn("digest", F.sha2(F.array_join("tokens", "\u0000"), 256)))
    classes = cut(sets.groupBy("digest").agg(F.min("record").alias("class_id"), F.first("tokens").alias("tokens"), F.count("*").alias("members")).withColumn("size", F.size("tokens")))
    # one class may hold a third of the records
    big = heavy_keys(classes, "digest", "members", sets.count())
    member = lookup(sets.select("record", "digest"), classes.select("digest", "class_id"), "digest", big).select("record", "class_id")
    return classes.select("class_id", "tokens", "size"), member


def _candidates(classes: DataFrame, threshold: float, crowd: int, depth: int) -> DataFrame:
    """(a, b) with a < b: the pairs of classes that share a signature, each once."""
    base = F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - F.lit(1e-9)).cast("int")
    sigs = classes.select("class_id", "size", "tokens", F.posexplode(F.slice("tokens", F.lit(1), base + 1)).alias("at", "token"))
    sigs = sigs.select("class_id", "size", "tokens", "at", F.xxhash64("token").alias("sig"))
    out = None
    for k in range(1, depth + 1):
        level = cut(sigs)
        counts = level.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
        small = counts if k == depth else counts.where(F.col("n") <= crowd)
        a = level.select("class_id", "size", "sig").join(small.select("sig"), "sig")
        b = a.select("sig", F.col("class_id").alias("b"), F.col("size").alias("b_size"))
        near = (F.least("size", "b_size") >= F.ceil(F.lit(threshold) * F.greatest("size", "b_size") - F.lit(1e-9)))
        found = a.withColumnRenamed("class_id", "a").join(b, "sig").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
        out = found if out is None else out.unionByName(found)
        if k == depth:
            break
        crowded = cut(counts.where(F.col("n") > crowd).select("sig"))
        if crowded.isEmpty():
            break
        # the signature grows by every later token of the prefix that is k tokens longer
        on = level.join(crowded, "sig", "left_semi")
        later = F.slice("tokens", F.col("at") + 2, F.greatest(base + k - F.col("at"), F.lit(0)))
        sigs = on.select("class_id", "size", "tokens", "sig", "at", F.posexplode(later).alias("step", "token"))
        sigs = sigs.select("class_id", "size", "tokens", (F.col("at") + 1 + F.col("step")).alias("at"), F.xxhash64("sig", "token").alias("sig"))
    return out.distinct()


def similar_classes(classes: DataFrame, threshold: float, crowd: int = CROWD, depth: int = DEPTH) -> DataFrame:
    """(a, b, shared, similarity): pairs of classes, a < b, whose Jaccard similarity is at least `threshold`, verified.

    `depth` must not exceed the tokens that any two similar classes share.
    """
    pairs = cut(_candidates(classes, threshold, crowd, depth))
    left = classes.select(F.col("class_id").alias("a"), F.col("tokens").alias("ta"))
    right = classes.select(F.col("class_id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("ta", "tb")))
    union = F.size("ta") + F.size("tb") - F.col("shared")
    out = both.where(F.col("shared") >= F.lit(threshold) * union - F.lit(1e-9))
    return out.select("a", "b", "shared", (F.col("shared") / union).alias("similarity"))


def similar_sets(rows: DataFrame, record: str, value: str, threshold: float = 0.5, least: int = 4) -> tuple[DataFrame, DataFrame]:
    """Similar pairs of classes of equal sets (see `similar_classes`), and (record, class_id) for all of them.

    `rows` has one row for each value of a record. Values compare without case and outer blanks; a null value or
    record counts for nothing, repeated rows count once, sets with fewer than `least` values take no part. An empty
    table gives empty results; other columns are ignored.
    """
    classes, member = set_classes(rows, record, value, least)
    classes = cut(classes)
    # similar sets of `least` tokens or more have at least so many in common, and no signature may ask for more
    common = math.ceil(2 * threshold * least / (1 + threshold) - 1e-9)
    return similar_classes(classes, threshold, depth=max(1, min(DEPTH, common))), member


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "citation_edges", "source", "target")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of sources, those with equal sets included."""
    pairs, member = similar_sets(_edges(spark, d), "source", "target")
    member = cut(member)
    a = member.select(F.col("class_id").alias("a"), F.col("record").alias("x"))
    b = member.select(F.col("class_id").alias("b"), F.col("record").alias("y"))
    across = pairs.select("a", "b").join(a, "a").join(b, "b").select("x", "y")
    # members of one class: each record meets the larger ones
    within = a.join(b.withColumnRenamed("b", "a"), "a").where("x < y").select("x", "y")
    both = across.unionByName(within)
    return both.select(F.least("x", "y").alias("source_a"), F.greatest("x", "y").alias("source_b"))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row for each source: its class of equal target sets and the number of other classes it is similar to."""
    pairs, member = similar_sets(_edges(spark, d), "source", "target")
    pairs = cut(pairs)
    n = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    return member.join(n, "class_id", "left").select(F.col("record").alias("source"), "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def p2_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of class representatives with their overlap."""
    pairs, _ = similar_sets(_edges(spark, d), "source", "target")
    return pairs.select("a", "b", F.col("shared").cast("long").alias("shared"), F.round("similarity", 6).alias("similarity"))


_SQL = """
WITH e AS (SELECT DISTINCT source, lower(trim(target)) AS target FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL),
s AS (SELECT source, list_sort(list(target)) AS targets, count(*) AS n FROM e GROUP BY source HAVING count(*) >= 4),
g AS (SELECT a.source AS a, b.source AS b, count(*) AS shared FROM e a JOIN e b ON a.target = b.target AND a.source < b.source GROUP BY ALL),
p AS (SELECT g.a, g.b, g.shared, g.shared / (x.n + y.n - g.shared) AS similarity FROM g JOIN s x ON x.source = g.a JOIN s y ON y.source = g.b
      WHERE 2 * g.shared >= x.n + y.n - g.shared),
c AS (SELECT source, min(source) OVER (PARTITION BY targets) AS class_id FROM s),
q AS (SELECT p.* FROM p JOIN c x ON x.source = p.a AND x.class_id = p.a JOIN c y ON y.source = p.b AND y.class_id = p.b)"""


def queries() -> dict:
    return {"p2_found": p2_found, "p2_classes": p2_classes, "p2_pairs": p2_pairs}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"{_SQL} SELECT a AS source_a, b AS source_b FROM p",
        "p2_classes": f"""{_SQL} SELECT c.source, c.class_id, (SELECT count(*) FROM q WHERE q.a = c.class_id OR q.b = c.class_id) AS links FROM c""",
        "p2_pairs": f"{_SQL} SELECT a, b, CAST(shared AS BIGINT) AS shared, round(similarity, 6) AS similarity FROM q",
    }
