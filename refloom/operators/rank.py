"""Transparent rankings: normalised dimensions, weights, sensitivity, hold-out, author credit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.plans.materialize import cut

#: Weights of the reading priority (fixed values).
WEIGHTS = {"indegree": 0.3, "rank": 0.3, "centrality": 0.2, "groups": 0.2}
DELTAS = (-0.1, -0.05, 0.05, 0.1)


def normalised(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Each dimension on 0 to 1 by its minimum and maximum over all rows, as n_<dim>; a flat one is 0. One pass for the bounds."""
    bounds = rows.agg(*[f(d).alias(f"{tag}_{d}") for d in dims for tag, f in (("lo", F.min), ("hi", F.max))]).first()
    out = rows
    for d in dims:
        lo, hi = bounds[f"lo_{d}"], bounds[f"hi_{d}"]
        out = out.withColumn(f"n_{d}", F.lit(0.0) if lo is None or lo == hi else (F.col(d) - F.lit(lo)) / F.lit(float(hi - lo)))
    return out


def scored(rows: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """rows with score: the weighted sum of normalised dimensions, to six places."""
    n = normalised(rows, list(weights))
    return n.withColumn("score", F.round(sum((F.lit(w) * F.col(f"n_{d}") for d, w in weights.items()), F.lit(0.0)), 6))


def top(rows: DataFrame, n: int, by: tuple[str, ...] = ("score", "indegree"), key: str = "node") -> DataFrame:
    """The n best rows with their place, of equal ones the smaller key first: a bounded top-k, not a global window."""
    order = [*map(F.desc, by), F.col(key)]
    return rows.orderBy(*order).limit(n).withColumn("place", F.row_number().over(W.orderBy(*order)))


def sensitivity(rows: DataFrame, weights: dict[str, float] = WEIGHTS, deltas: tuple[float, ...] = DELTAS, n: int = 10, key: str = "node", then: str = "indegree") -> DataFrame:
    """(dim, delta, entered, left, changed): how the first n change when one weight moves, all variants in one pass.

    Of equal scores the larger `then` comes first, then the smaller key.
    Every variant's shortlist is found by a top-n aggregation for each variant, so no variant is a job of its own.
    """
    base = cut(normalised(rows, list(weights)).select(key, F.col(then).alias("then"), *[f"n_{d}" for d in weights]))
    variants = [("", 0.0), *[(d, delta) for d in weights for delta in deltas]]
    score = lambda dim, delta: F.round(sum((F.lit(max(0.0, w + (delta if d == dim else 0.0))) * F.col(f"n_{d}") for d, w in weights.items()), F.lit(0.0)), 6)
    lists = None
    long = base.select(key, "then", F.explode(F.array(*[F.struct(F.lit(i).alias("v"), score(*v).alias("score")) for i, v in enumerate(variants)])).alias("s")).select(key, "then", "s.v", "s.score")
    # the best n of each variant among those of each bucket of rows: two bounded steps
    part = long.withColumn("b", F.pmod(F.xxhash64(key), F.lit(64)))
    rank = lambda by: F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), F.desc("then"), key))
    few = part.withColumn("r", rank(["v", "b"])).where(F.col("r") <= n)
    lists = few.withColumn("r", rank(["v"])).where(F.col("r") <= n).groupBy("v").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", key))), lambda x: x[key]).alias("list"))
    lists = cut(lists)
    first = lists.where("v = 0").select(F.col("list").alias("base"))
    names = base.sparkSession.createDataFrame([(i, d, delta) for i, (d, delta) in enumerate(variants)], "v int, dim string, delta double")
    out = lists.where("v > 0").join(F.broadcast(names), "v").join(F.broadcast(first))
    join = lambda c: F.array_join(F.array_sort(c), ",")
    return out.select("dim", "delta", join(F.array_except("list", "base")).alias("entered"), join(F.array_except("base", "list")).alias("left"), (F.col("list") != F.col("base")).alias("changed"))


def author_credit(authorship: DataFrame, indegree: DataFrame) -> DataFrame:
    """(author, works, credit, coauthors): each work's citations are shared by its team; coauthors are different authors.

    Coauthor pairs come from works, whose teams are small; the counts are combined before their exchange.
    """
    a = cut(authorship.select("author", "work", "team"))
    credit = a.join(indegree.withColumnRenamed("target", "work"), "work", "left").groupBy("author").agg(
        F.countDistinct("work").alias("works"), F.round(F.sum(F.coalesce("indegree", F.lit(0)) / F.col("team")), 4).alias("credit")
    )
    d = a.select("author", "work").distinct()
    met = d.join(d.withColumnRenamed("author", "other"), "work").where("author <> other").groupBy("author").agg(F.countDistinct("other").alias("coauthors"))
    return credit.join(met, "author", "left").select("author", "works", "credit", F.coalesce("coauthors", F.lit(0)).alias("coauthors"))


def author_ranking(authorship: DataFrame, indegree: DataFrame, groups: DataFrame, best: DataFrame) -> DataFrame:
    """`author_credit` with display_names, seed_groups, top_contribution and the least certain identity of each author.

    `authorship` has author, work, name, team, confidence, basis; `groups` (work, grp) tells each work's group, `best`
    (work) the works whose teams share the top contribution.
    """
    a = cut(authorship)
    rows = a.join(groups, "work", "left").join(best.withColumn("top", F.lit(True)), "work", "left")
    names = rows.groupBy("author").agg(
        F.array_join(F.array_sort(F.collect_set("name")), "; ").alias("display_names"), F.countDistinct("grp").alias("seed_groups"),
        F.round(F.sum(F.when(F.col("top"), 1 / F.col("team")).otherwise(0.0)), 4).alias("top_contribution"),
        F.min("confidence").alias("identity_confidence"), F.min_by("basis", F.struct("work", "position")).alias("identity_basis"),
    )
    return author_credit(a, indegree).join(names, "author")
