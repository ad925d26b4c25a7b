"""How distinctive a term is per record: divergence from randomness.

The information of a term's frequency under a geometric model of the collection,

    inf(tfn) = log2(1 + L) + tfn * log2((1 + L) / L),    L = occurrences in the collection / records,

is multiplied by the Laplace after-effect gain 1 / (tfn + 1). tfn is the frequency in the record normalised by its
length, tfn = tf * log2(1 + c * mean length / length).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions.text import folded, words
from refloom.plans.materialize import cut
from refloom.plans.skew import heavy_keys, lookup
from refloom.sources.tables import table


def term_scores(records: DataFrame, record_id: str, text: str, c: float = 1.0, least: int = 3, presence: bool = False) -> DataFrame:
    """(record_id, term, tf, length, df, cf, tfn, score, records): one row for each different word of each record.

    With `presence` a word counts once in a record, however often it stands there: the rate of the geometric model is
    then the word's records over all records, and tf is 1. That suits titles, where repetition says little.

    Words are runs of a-z and 0-9 of at least `least` characters of the folded text. A record whose text is null or
    holds no such word gives no row, nor does a null id; it does not count as a record of the collection. Of repeated
    rows of one id the smallest text counts, so copies change nothing. Texts are read whole. Equal terms of equally
    long records tie. Other columns are ignored, whatever their names.

    Words are counted in place after one exchange by record. Collection counts are combined before their exchange by
    term, and they come back to the rows by a lookup that scatters the terms which hold over a thousandth of all rows.
    """
    one = records.select(F.col(record_id).cast("string").alias("record_id"), F.col(text).cast("string").alias("text"))
    one = one.where("record_id is not null").groupBy("record_id").agg(F.min("text").alias("text"))
    spread = one.select("record_id", F.explode(words(folded(F.col("text")), least)).alias("term"))
    rows = cut(
        spread.groupBy("record_id", "term").agg(F.count("*").alias("tf")).withColumn("length", F.sum("tf").over(W.partitionBy("record_id")))
    )
    total = rows.agg(F.countDistinct("record_id").alias("n"), F.sum("tf").alias("words"), F.count("*").alias("rows")).first()
    n, mean = total["n"], (total["words"] or 0) / max(total["n"], 1)
    stats = cut(rows.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")))
    joined = lookup(rows, stats, "term", heavy_keys(stats, "term", "df", total["rows"]))
    rate = F.col("df" if presence else "cf") / F.lit(float(max(n, 1)))
    tfn = (F.lit(1) if presence else F.col("tf")) * F.log2(1 + F.lit(c * mean) / F.col("length"))
    score = (F.log2(1 + rate) + tfn * F.log2((1 + rate) / rate)) / (tfn + 1)
    return joined.select("record_id", "term", "tf", "length", "df", "cf", tfn.alias("tfn"), score.alias("score"), F.lit(n).alias("records"))


def most_distinctive(scores: DataFrame, most: int = 6) -> DataFrame:
    """Of each record's scored terms that other records share, those with the highest score, if it is that of at most `most` records.

    `scores` come from `term_scores` with `presence`. All terms of a record have its length, so terms of equally many
    records tie exactly, and all of a tie are kept. A term that is no rarer in the collection than in the record carries no
    information; below that the score falls as the number of records rises. The bar is the score of a term in `most` records.
    """
    tfn = F.col("tfn")
    rare = scores.where((F.col("df") >= 2) & (F.col("df") / F.col("records") < tfn))
    best = rare.withColumn("best", F.max("score").over(W.partitionBy("record_id"))).where(F.col("score") == F.col("best"))
    rate = F.least(F.lit(float(most)) / F.col("records"), tfn)
    bar = (F.log2(1 + rate) + tfn * F.log2((1 + rate) / rate)) / (tfn + 1)
    return best.where(F.col("score") >= bar - F.lit(1e-12)).select("record_id", "term", "df", "score")


def titles(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "corpus", "work_id", "title")
    discovered = table(spark, d, "discovered", "discovered_id", "title")
    return corpus.toDF("record_id", "title").unionByName(discovered.toDF("record_id", "title"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The shared terms of the highest score in each title. With every word counted once a title, they are those of the fewest titles."""
    return most_distinctive(term_scores(titles(spark, d), "record_id", "title", presence=True)).select("record_id", "term")


def p1_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every word of every title with its score."""
    s = term_scores(titles(spark, d), "record_id", "title")
    return s.select("record_id", "term", "tf", "df", "cf", F.round("score", 6).alias("score"))


def p1_top_terms(spark: SparkSession, d: str) -> DataFrame:
    """The three most distinctive words of each title."""
    s = term_scores(titles(spark, d), "record_id", "title").withColumn("score", F.round("score", 6))
    rank = F.row_number().over(W.partitionBy("record_id").orderBy(F.desc("score"), "term"))
    return s.withColumn("rank", rank).where("rank <= 3").select("record_id", "rank", "term", "score")


#: The compatibility characters that NFKD takes apart and strip_accents leaves (fixed values, those of Latin-1).
_COMPATIBLE = {"¼": "1/4", "½": "1/2", "¾": "3/4", "¹": "1", "²": "2", "³": "3", "ª": "a", "º": "o", "…": "..."}
_FLAT = "title"
for _from, _to in _COMPATIBLE.items():
    _FLAT = f"replace({_FLAT}, '{_from}', '{_to}')"

_SQL = f"""
WITH t AS (
  SELECT record_id, min(title) AS title FROM (
    SELECT work_id AS record_id, title FROM corpus UNION ALL SELECT discovered_id, title FROM discovered)
  GROUP BY record_id
), w AS (
  SELECT record_id, term, count(*) AS tf FROM (
    SELECT record_id, unnest(regexp_extract_all(lower(strip_accents({_FLAT})), '[a-z0-9]{{3,}}')) AS term FROM t)
  GROUP BY ALL
), s AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM w GROUP BY term),
l AS (SELECT record_id, sum(tf) AS len FROM w GROUP BY record_id),
n AS (SELECT count(*) AS n, sum(len) / count(*) AS mean FROM l),
f AS (
  SELECT record_id, term, tf, df, cf, cf / n.n AS rate, tf * log2(1 + mean / len) AS tfn
  FROM w JOIN s USING (term) JOIN l USING (record_id), n
), r AS (
  SELECT record_id, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf,
    round((log2(1 + rate) + tfn * log2((1 + rate) / rate)) / (tfn + 1), 6) AS score FROM f
)"""


def queries() -> dict:
    return {"p1_found": p1_found, "p1_scores": p1_scores, "p1_top_terms": p1_top_terms}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""{_SQL} SELECT record_id, term FROM (
            SELECT *, min(df) OVER (PARTITION BY record_id) AS fewest FROM r WHERE df >= 2) WHERE df = fewest AND df <= 6""",
        "p1_scores": f"{_SQL} SELECT record_id, term, tf, df, cf, score FROM r",
        "p1_top_terms": f"""{_SQL} SELECT record_id, CAST(rank AS INTEGER) AS rank, term, score FROM (
            SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY score DESC, term) AS rank FROM r) WHERE rank <= 3""",
    }
