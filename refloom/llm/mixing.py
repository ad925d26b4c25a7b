"""Mixing sources to target weights: pivotal dependent rounding.

The total is the largest at which no source needs more than its repeats: for each source, share x total is at most
repeats x size. Every text of a source is then wanted r times, r the same for all of them: its whole part is copied, the
fraction is a copy probability that is rounded dependently. Two texts with fractional probabilities meet and transfer
mass, probability times tokens, at random and fairly until one is 0 or 1; the other goes on. Texts meet by falling
size; the last of each size class meets all smaller texts of its group at once, which share what it gives or takes. So
every text keeps its probability in expectation while the tokens of each source stay as they are, up to one small text.
Groups of texts are rounded apart and leave one text each, which meet in a reduction tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.llm.tokens import token_counts
from refloom.plans.materialize import cut
from refloom.sources.tables import table

#: Texts per group, and groups whose last texts meet at the next level.
GROUP, FAN = 50_000, 64
SEED = 42


def transfer(p: float, m: float, q: float, n: float, u: float) -> tuple[float, float]:
    """New probabilities of two texts of m and n tokens; u is uniform in [0, 1). One of them is 0 or 1 exactly."""
    up, down = min((1 - p) * m, q * n), min(p * m, (1 - q) * n)
    if up + down <= 0:
        return p, q
    if u * (up + down) < down:
        return (1.0, q - up / n) if (1 - p) * m <= q * n else (p + up / m, 0.0)
    return (0.0, q + down / n) if p * m <= (1 - q) * n else (p - down / m, 1.0)


_EPS = 1e-9


def _round(first: bool, last: bool):
    """Rows sorted by (source, grp) and falling size; columns doc_id, source, grp, tokens, p, u, rest.

    rest are the tokens from the row to the end of its group. In the first round, where a group's texts have one
    probability, the last of a size class is settled against the smaller ones. At the end a group's last text is settled
    if this is the last round.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, shift = None, None, 0.0

        def settle(h: tuple, one: float) -> tuple:
            doc, tokens, p, u = h
            if _EPS < p < 1 - _EPS:
                return (doc, *key, tokens, (1.0 if u < p else 0.0) if one else p, u)
            return (doc, *key, tokens, float(round(p)), u)

        for pdf in parts:
            out = []
            for doc, source, g, n, p, u, rest in zip(pdf["doc_id"], pdf["source"], pdf["grp"], pdf["tokens"], pdf["p"], pdf["u"], pdf["rest"], strict=True):
                if (source, g) != key:
                    if held is not None:
                        out.append(settle(held, last))
                    key, held, shift = (source, g), None, 0.0
                p += shift
                if first and held is not None and int(n).bit_length() < int(held[1]).bit_length() and rest > held[1]:
                    hd, hn, hp, hu = held
                    whole = 1.0 if hu < hp else 0.0
                    more = (hp - whole) * hn / rest
                    if _EPS < p + more < 1 - _EPS:
                        out.append((hd, *key, hn, whole, hu))
                        held, shift, p = None, shift + more, p + more
                if held is None:
                    held = (doc, n, p, u)
                    continue
                hd, hn, hp, hu = held
                a, b = transfer(hp, max(hn, 1), p, max(n, 1), u)
                if _EPS < a < 1 - _EPS:
                    held = (hd, hn, a, hu)
                    out.append((doc, *key, n, float(round(b)), u))
                else:
                    out.append((hd, *key, hn, float(round(a)), hu))
                    held = (doc, n, b, u)
            yield pd.DataFrame(out, columns=["doc_id", "source", "grp", "tokens", "p", "u"])
        if held is not None:
            yield pd.DataFrame([settle(held, last)], columns=["doc_id", "source", "grp", "tokens", "p", "u"])

    return run


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, texts, available, share, wanted, repeats): what each target asks for.

    A source without tokens or with a share of null or none or below gets nothing, and the others' shares are scaled to 1, as
    they are when the shares do not add up; a null cap counts as 1. Of repeated targets of a source the largest counts.
    """
    t = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    have = sizes.groupBy("source").agg(F.count("*").alias("texts"), F.sum("tokens").alias("available"))
    p = t.join(have, "source", "left").na.fill({"texts": 0, "available": 0})
    live = (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    p = cut(p.withColumn("live", F.coalesce(live, F.lit(False))))
    total = p.where("live").agg(F.sum("target_share").alias("s")).first()["s"] or 1.0
    p = p.withColumn("share", F.when(F.col("live"), F.col("target_share") / F.lit(total)).otherwise(0.0))
    size = p.where("live").agg(F.min(F.col("max_repeats") * F.col("available") / F.col("share")).alias("t")).first()["t"] or 0.0
    p = p.withColumn("wanted", F.col("share") * F.lit(size))
    return p.withColumn("repeats", F.when(F.col("live"), F.least(F.col("wanted") / F.col("available"), F.col("max_repeats").cast("double"))).otherwise(0.0)).drop("live")


def mix(sizes: DataFrame, targets: DataFrame, group: int = GROUP, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, copies) of the texts that are copied, and the plan.

    `sizes` has doc_id, source, tokens; texts without a source, or of a source that is no target, are left out. The same
    rows and seed give the same copies. Copies never exceed max_repeats. Empty tables give empty results.
    """
    p = cut(plan(sizes, targets))
    # one row for each target; targets are given by hand, and a source meets one of them
    wanted = p.where("repeats > 0").select("source", "repeats")
    key = sizes.schema["doc_id"].dataType.simpleString()
    rows = sizes.where("doc_id is not null and source is not null").join(wanted, "source").withColumn("whole", F.floor(F.col("repeats") + _EPS))
    rows = rows.withColumn("p", F.greatest(F.col("repeats") - F.col("whole"), F.lit(0.0)))
    rows = cut(rows.select("doc_id", "source", "tokens", "whole", "p"))
    n = rows.where(f"p > {_EPS}").count()
    groups = max(1, -(-n // group))
    uniform = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    h = F.xxhash64("doc_id", F.lit(seed + 1))
    live = rows.where(f"p > {_EPS}").select("doc_id", "source", F.pmod(h, F.lit(groups)).cast("int").alias("grp"), "tokens", "p", uniform.alias("u"))
    falling = W.partitionBy("source", "grp").orderBy(F.desc("tokens"), "doc_id").rowsBetween(0, W.unboundedFollowing)
    shape = f"doc_id {key}, source string, grp int, tokens long, p double, u double"
    settled = None
    while True:
        last = groups == 1
        # a group is bounded, so its window is
        met = live.withColumn("rest", F.sum("tokens").over(falling)).repartition("source", "grp").sortWithinPartitions("source", "grp", F.desc("tokens"), "doc_id")
        done = cut(met.mapInPandas(_round(settled is None, last), shape))
        whole = done.where(f"p <= {_EPS} or p >= {1 - _EPS}").select("doc_id", F.round("p").cast("long").alias("more"))
        settled = whole if settled is None else settled.unionByName(whole)
        if last:
            break
        groups = -(-groups // FAN)
        fresh = F.pmod(F.xxhash64("doc_id", F.lit(seed + groups + 2)), F.lit(1 << 52)) / F.lit(float(1 << 52))
        live = done.where(f"p > {_EPS} and p < {1 - _EPS}").select("doc_id", "source", F.expr(f"grp div {FAN}").cast("int").alias("grp"), "tokens", "p", fresh.alias("u"))
    copies = rows.join(settled, "doc_id", "left").withColumn("copies", F.col("whole") + F.coalesce("more", F.lit(0)))
    return copies.where("copies > 0").select("doc_id", "source", "tokens", "copies"), p


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = cut(token_counts(table(spark, d, "documents", "doc_id", "text", "source"), "doc_id", "text", "source"))
    return sizes, table(spark, d, "mix_targets", "source", "target_share", "max_repeats")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the mixture with their copies."""
    return mix(*_inputs(spark, d))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """For each target the share it asked for and the share it got, in tokens."""
    copies, p = mix(*_inputs(spark, d))
    got = copies.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed"), F.max("copies").alias("most_copies"))
    out = cut(p.join(got, "source", "left").na.fill({"mixed": 0, "most_copies": 0}))
    total = out.agg(F.sum("mixed")).first()[0] or 1
    return out.select("source", "target_share", "max_repeats", "texts", "available", F.round("share", 6).alias("share_of_present"), F.col("mixed").cast("long").alias("mixed"), F.round(F.col("mixed") / F.lit(total), 6).alias("actual_share"), F.col("most_copies").cast("int").alias("most_copies"))


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """For each target whose source has texts: no text is copied too often, and the source's share is met up to one of its texts."""
    copies, p = mix(*_inputs(spark, d))
    copies = cut(copies)
    got = copies.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed"), F.max("copies").alias("most"), F.max("tokens").alias("largest"))
    total = got.agg(F.sum("mixed")).first()[0] or 1
    out = p.where("share > 0").join(got, "source", "left").na.fill(0)
    met = F.abs(F.col("mixed") - F.col("share") * F.lit(total)) <= F.greatest(F.col("largest"), F.lit(0.02 * total))
    return out.select("source", (F.col("most") <= F.col("max_repeats")).alias("within"), met.alias("met"))


def queries() -> dict:
    return {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_invariants": p9_invariants}


def oracle_sql() -> dict[str, str]:
    return {
        "p9_invariants": """SELECT DISTINCT t.source, true AS within, true AS met FROM mix_targets t
            WHERE t.target_share > 0 AND coalesce(t.max_repeats, 1) > 0 AND t.source IN (SELECT source FROM documents WHERE length(text) > 0)"""
    }
