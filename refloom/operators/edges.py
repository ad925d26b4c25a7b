"""Edges derived from citations: collapsed citations, coupling, co-citation, authorship, merged records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions.bibliographic import author_key, match_key, surname
from refloom.plans.materialize import cut

#: A vertex that more than one part in HUB of the edges touch is a hub; there are fewer than HUB of them.
HUB = 200


def citations(edges: DataFrame, order: list[str]) -> DataFrame:
    """(source, target, weight, method, confidence): one row for each pair; method and confidence of its first row by `order`.

    A null end is no citation. Partial aggregation happens before the exchange, so a hot pair costs one row a task.
    """
    first = F.struct(*order)
    return edges.where("source is not null and target is not null").groupBy("source", "target").agg(
        F.count("*").alias("weight"), F.min_by("method", first).alias("method"), F.round(F.min_by("confidence", first), 4).alias("confidence")
    )


def shared_pairs(edges: DataFrame, item: str, through: str, least: int = 2) -> DataFrame:
    """(a, b, shared, size_a, size_b, cosine): pairs a < b of `item` with at least `least` of `through` in common.

    Bibliographic coupling is item = source, through = target; co-citation the other way round. Pairs meet on what they
    share. What nearly everything shares would pair everything, so hubs (fewer than HUB) make no pairs: items keep the
    hubs they touch in an array, a pair that has met elsewhere counts them by intersection, and pairs that share only
    hubs meet on `least` hubs at once, which they do only if they belong to the result.
    """
    e = cut(edges.select(F.col(item).alias("i"), F.col(through).alias("t")).where("i is not null and t is not null").distinct())
    n = e.count()
    degree = cut(e.groupBy("t").agg(F.count("*").alias("d")))
    hub = degree.where((F.col("d") * HUB > n) & (F.col("d") > 30)).select("t")
    plain = e.join(F.broadcast(hub), "t", "left_anti")
    a, b = plain.select("t", F.col("i").alias("a")), plain.select("t", F.col("i").alias("b"))
    met = a.join(b, "t").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))
    hubs = cut(e.join(F.broadcast(hub), "t").groupBy("i").agg(F.array_sort(F.collect_set("t")).alias("hubs")))
    # all combinations of `least` of an item's hubs, as one key
    combos = hubs.select("i", F.transform("hubs", lambda h: F.struct(h.alias("last"), h.alias("key"))).alias("c"), "hubs")
    combos = combos.select("i", "hubs", F.explode("c").alias("c"))
    for _ in range(least - 1):
        combos = combos.select("i", "hubs", F.col("c.key").alias("k"), F.explode(F.filter("hubs", lambda h: h > F.col("c.last"))).alias("h"))
        combos = combos.select("i", "hubs", F.struct(F.col("h").alias("last"), F.concat_ws("\u0001", "k", "h").alias("key")).alias("c"))
    keys = combos.select(F.col("c.key").alias("k"), "i")
    through_hubs = keys.select("k", F.col("i").alias("a")).join(keys.select("k", F.col("i").alias("b")), "k").where("a < b").select("a", "b").distinct()
    pairs = met.unionByName(through_hubs.withColumn("n", F.lit(0).cast("long"))).groupBy("a", "b").agg(F.sum("n").alias("n"))
    size = e.groupBy("i").agg(F.count("*").alias("size"))
    known = cut(size.join(hubs, "i", "left"))
    left = known.select(F.col("i").alias("a"), F.col("size").alias("size_a"), F.col("hubs").alias("ha"))
    right = known.select(F.col("i").alias("b"), F.col("size").alias("size_b"), F.col("hubs").alias("hb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.col("n") + F.coalesce(F.when(F.col("ha").isNotNull() & F.col("hb").isNotNull(), F.size(F.array_intersect("ha", "hb"))), F.lit(0)))
    cosine = F.round(F.col("shared") / F.sqrt(F.col("size_a") * F.col("size_b")), 6)
    return both.where(F.col("shared") >= least).select("a", "b", "shared", "size_a", "size_b", cosine.alias("cosine"))


def indegree(pairs: DataFrame) -> DataFrame:
    """(target, indegree): how many different sources cite each target; weights do not count."""
    return pairs.where("source is not null and target is not null").select("source", "target").distinct().groupBy("target").agg(F.count("*").alias("indegree"))


def centrality(coupling: DataFrame) -> DataFrame:
    """(node, centrality): the sum of a work's coupling cosines over both ends."""
    return coupling.select(F.explode(F.array("a", "b")).alias("node"), "cosine").groupBy("node").agg(F.round(F.sum("cosine"), 6).alias("centrality"))


def authorship(works: DataFrame, work: str, authors: str, confidence: float, basis: str) -> DataFrame:
    """(author, work, position, name, team, confidence, basis): one row for each author of each work, in order from 1.

    team counts the rows of a work, repeated names included. Null names make no row.
    """
    one = works.select(F.col(work).alias("work"), F.col(authors).alias("authors")).where("work is not null").dropDuplicates(["work"])
    rows = one.select("work", F.size(F.filter("authors", lambda a: a.isNotNull())).alias("team"), F.posexplode("authors").alias("position", "name")).where("name is not null")
    return rows.select(F.concat(F.lit("author:"), author_key(F.col("name"))).alias("author"), "work", (F.col("position") + 1).alias("position"), "name", "team", F.lit(confidence).alias("confidence"), F.lit(basis).alias("basis"))


def merge_key(title: Column, year: Column, authors: Column) -> Column:
    """What two records must share to be one work: match key of title, year, first surname; null where one is missing."""
    t, s = match_key(title), match_key(surname(F.get(authors, F.lit(0))))
    return F.when((F.length(t) > 0) & year.isNotNull() & (F.length(s) > 0), F.concat_ws("|", t, year.cast("string"), s))


def merge_records(records: DataFrame) -> DataFrame:
    """(id, canonical_id): records with one merge key share the id of the best: with a DOI, then an ISBN, then the smallest.

    Records without a full key stand for themselves. The best of a key is found by partial aggregation and joined back.
    """
    one = records.select("id", "title", "authors", "year", "doi", "isbn").where("id is not null").dropDuplicates(["id"])
    keyed = cut(one.select("id", merge_key(F.col("title"), F.col("year"), F.col("authors")).alias("key"), F.col("doi").isNull().alias("no_doi"), F.col("isbn").isNull().alias("no_isbn")))
    best = keyed.where("key is not null").groupBy("key").agg(F.min_by("id", F.struct("no_doi", "no_isbn", "id")).alias("best"))
    return keyed.where("key is not null").join(best, "key").select("id", F.col("best").alias("canonical_id")).unionByName(keyed.where("key is null").select("id", F.col("id").alias("canonical_id")))


def merged_records(records: DataFrame) -> DataFrame:
    """(id, doi, isbn, cited_by, merged_from) of records (id, title, authors, year, doi, isbn, cited_by) after `merge_records`.

    The canonical record's DOI and ISBN count first, then those of the others by what else they have and by id. The
    lists that cite them are united and sorted as text, as are the ids merged away.
    """
    one = records.where("id is not null").dropDuplicates(["id"])
    rows = cut(one.select("id", "doi", "isbn", "cited_by").join(merge_records(records), "id"))
    other = (F.col("id") != F.col("canonical_id")).alias("other")
    first = lambda c, beside: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(other, F.col(beside).isNull().alias("bare"), "id"))).alias(c)
    main = rows.groupBy("canonical_id").agg(first("doi", "isbn"), first("isbn", "doi"), F.array_join(F.array_sort(F.collect_set(F.when(other, F.col("id")))), " ").alias("merged_from"))
    cited = rows.select("canonical_id", F.explode("cited_by").alias("c")).where("c is not null").groupBy("canonical_id").agg(F.array_join(F.array_sort(F.collect_set("c")), " ").alias("cited_by"))
    out = main.join(cited, "canonical_id", "left")
    return out.select(F.col("canonical_id").alias("id"), "doi", "isbn", F.coalesce("cited_by", F.lit("")).alias("cited_by"), "merged_from")


def promoted(records: DataFrame, alias: DataFrame) -> DataFrame:
    """(source, target, weight): citations of records (id, cited_by) with the ids of `alias` (id, canonical_id) in place of their own."""
    one = records.where("id is not null").dropDuplicates(["id"]).select("id", F.explode("cited_by").alias("source")).where("source is not null")
    there = one.join(alias, "id", "left").select("source", "id", F.coalesce("canonical_id", "id").alias("target"))
    return there.groupBy("source", "target").agg(F.countDistinct("id").alias("weight"))


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by `order`: the view of an append-only log as a table with that primary key.

    It is an aggregation (one row a key leaves each task), not a window over a key's rows.
    """
    cols = [c for c in rows.columns if c != key]
    top = rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r"))
    return top.select(key, *[F.col("r")[c].alias(c) for c in cols])


def window_rank(by: list[str], order: list) -> Column:
    return F.row_number().over(W.partitionBy(*by).orderBy(*order))
