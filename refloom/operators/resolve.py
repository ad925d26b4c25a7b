"""Conservative resolution of references: accepted only when a match is strong and alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.bibliographic import discovered_id, doi, isbn13, match_key, surname
from refloom.functions.text import folded
from refloom.plans.materialize import cut

#: Scores by evidence, the score from which a match is accepted and the lead it needs over another work (fixed values).
BY_ID, BY_ALL, BY_YEAR, BY_TITLE = 1.0, 0.96, 0.90, 0.72
ACCEPT, MARGIN = 0.95, 0.05


def index(works: DataFrame) -> DataFrame:
    """(kind, key, work, year, surnames): DOI and ISBN keys point to the largest work that has them, titles to all."""
    w = works.select("work_id", "title", "year", "authors", "identifiers").where("work_id is not null").dropDuplicates(["work_id"])
    w = cut(w.select(F.col("work_id").alias("work"), match_key(F.col("title")).alias("t"), "year", surname_keys(F.col("authors")).alias("surnames"), doi(F.try_element_at("identifiers", F.lit("doi"))).alias("d"), isbn13(F.try_element_at("identifiers", F.lit("isbn"))).alias("i")))
    body = F.struct("work", "year", "surnames")
    one = lambda c, kind: w.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("key")).agg(F.max_by(body, "work").alias("b")).select(F.lit(kind).alias("kind"), "key", "b.*")
    titles = w.where("length(t) > 0").select(F.lit("title").alias("kind"), F.col("t").alias("key"), "work", "year", "surnames")
    return one("d", "doi").unionByName(one("i", "isbn")).unionByName(titles)


def surname_keys(authors: Column) -> Column:
    """The match keys of the surnames in a list of names; the list is folded as one text, since lambdas take no UDF."""
    flat = folded(F.array_join(F.transform(F.filter(authors, lambda a: a.isNotNull()), surname), "\n"))
    return F.transform(F.split(flat, "\n"), lambda s: F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " ")))


def resolve(refs: DataFrame, works: DataFrame) -> DataFrame:
    """(ref_id, status, target_id, method, score): resolved, ambiguous, discovered or unresolved, one row a reference.

    A reference meets the index by DOI, ISBN and title. The best work is compared with the best other work: within the
    margin or below the accepted score the reference is ambiguous. Without candidates it is a discovery if anything
    identifies it. The two best are found by aggregation, so a reference's candidates never gather in one place.
    """
    r = refs.select("ref_id", "doi", "isbn", "title", "year", "authors").where("ref_id is not null").dropDuplicates(["ref_id"])
    first = F.get("authors", F.lit(0))
    r = cut(r.select("ref_id", doi(F.col("doi")).alias("d"), isbn13(F.col("isbn")).alias("i"), match_key(F.col("title")).alias("t"), "year", match_key(surname(first)).alias("who"), first.alias("first"), "title"))
    keys = r.select("ref_id", F.col("year").alias("ry"), "who", F.explode(F.array(F.struct(F.lit("doi").alias("kind"), F.col("d").alias("key")), F.struct(F.lit("isbn").alias("kind"), F.col("i").alias("key")), F.struct(F.lit("title").alias("kind"), F.col("t").alias("key")))).alias("k")).select("ref_id", "ry", "who", "k.*")
    keys = keys.where("key is not null and key <> ''")
    met = keys.join(index(works), ["kind", "key"])
    same_year = F.col("ry") == F.col("year")
    score = F.when(F.col("kind") != "title", BY_ID).when(same_year & F.array_contains("surnames", F.col("who")), BY_ALL).when(same_year, BY_YEAR).otherwise(BY_TITLE)
    cand = met.withColumn("score", score).groupBy("ref_id", "work").agg(F.max(F.struct("score", "kind")).alias("m")).select("ref_id", "work", "m.score", "m.kind")
    cand = cut(cand)
    # ties go to the smallest work
    best = cand.groupBy("ref_id").agg(F.min_by(F.struct("work", "score", "kind"), F.struct((-F.col("score")).alias("s"), "work")).alias("b"))
    rival = cand.join(best, "ref_id").where(F.col("work") != F.col("b.work")).groupBy("ref_id").agg(F.max("score").alias("rival"))
    out = r.join(best, "ref_id", "left").join(rival, "ref_id", "left")
    known = F.col("d").isNotNull() | F.col("i").isNotNull() | (F.length("t") > 0)
    close = F.col("rival").isNotNull() & (F.col("b.score") - F.col("rival") < MARGIN)
    status = F.when(F.col("b").isNull(), F.when(known, "discovered").otherwise("unresolved")).when(close | (F.col("b.score") < ACCEPT), "ambiguous").otherwise("resolved")
    basis = F.concat_ws("|", "who", F.coalesce("title", F.lit("")), F.coalesce(F.col("year").cast("string"), F.lit("None")))
    target = F.when(status == "resolved", F.col("b.work")).when(status == "discovered", discovered_id(F.col("d"), F.col("i"), basis))
    return out.select("ref_id", status.alias("status"), target.alias("target_id"), F.when(status == "resolved", F.col("b.kind")).alias("method"), F.when(F.col("b").isNotNull(), F.col("b.score")).alias("score"))


def enriched(resolved: DataFrame, refs: DataFrame, known: DataFrame) -> DataFrame:
    """resolved with `enrichment`: the id a static table (doi, id) gives for the DOI of references without a decisive match.

    References that are decided are filtered out before the join, so only the open ones travel.
    """
    open_ = resolved.where(F.coalesce("score", F.lit(0.0)) < ACCEPT).select("ref_id")
    keys = refs.select("ref_id", doi(F.col("doi")).alias("d")).where("d is not null").dropDuplicates(["ref_id"]).join(open_, "ref_id", "left_semi")
    table = known.select(doi(F.col("doi")).alias("d"), "id").where("d is not null").groupBy("d").agg(F.min("id").alias("enrichment"))
    return resolved.join(keys.join(table, "d").select("ref_id", "enrichment"), "ref_id", "left")


def summary(resolved: DataFrame) -> DataFrame:
    """(status, method, refs): how many references came out how."""
    return resolved.groupBy("status", F.coalesce("method", F.lit("-")).alias("method")).agg(F.count("*").alias("refs"))
