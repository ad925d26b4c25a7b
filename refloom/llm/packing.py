"""Filling fixed-capacity containers: bounded-space online best-fit.

A fixed number of containers is open at a time. They lie in a bitset keyed by their free space, so the open container
with the least space that still holds an item is the lowest set bit from the item's size on. An item that fits nowhere
opens a container; when that would be one too many, the fullest closes first. Items are never split unless they exceed
the capacity; then they fill containers of their own and the rest is an item.

Items are dealt into groups by a hash, each packed on its own. What is still open at a group's end goes on as whole
to the next level, where many groups' open containers are best-fitted into each other, until one group is left; so
parallel packing leaves no more room than a few containers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.llm.tokens import token_counts
from refloom.plans.materialize import cut
from refloom.sources.tables import table

#: Open containers per group, items per group, and groups whose open containers meet at the next level.
OPEN, GROUP, FAN = 64, 25_000, 32


class Packer:
    """Open containers of one capacity, by free space."""

    def __init__(self, capacity: int, most: int = OPEN) -> None:
        self.capacity, self.most = capacity, most
        self.mask, self.open, self.by_free = 0, 0, {}
        self.made = 0

    def put(self, size: int) -> int:
        """The number of the container that takes an item of `size`, which is at most the capacity."""
        rest = self.mask >> size
        if rest:
            free = size + (rest & -rest).bit_length() - 1
            bins = self.by_free[free]
            b = bins.pop()
            if not bins:
                self.mask ^= 1 << free
            self.open -= 1
        else:
            if self.open >= self.most:
                free = (self.mask & -self.mask).bit_length() - 1  # the fullest
                bins = self.by_free[free]
                bins.pop()
                if not bins:
                    self.mask ^= 1 << free
                self.open -= 1
            free, b = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(b)
            self.mask |= 1 << left
            self.open += 1
        return b

    def still_open(self) -> dict[int, int]:
        """Container: used space."""
        return {b: self.capacity - free for free, bins in self.by_free.items() for b in bins}


def _first(capacities: dict[int, int]):
    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, packers = None, {}

        def close() -> pd.DataFrame:
            rows = [(pack_id, group, b, used) for pack_id, p in packers.items() for b, used in p.still_open().items()]
            df = pd.DataFrame(rows, columns=["pack_id", "grp", "bin", "used"])
            return df.assign(doc_id=None, piece=-1, tokens=0)

        for pdf in parts:
            out = []
            for doc, g, n in zip(pdf["doc_id"], pdf["grp"], pdf["tokens"], strict=True):
                if g != group:
                    if group is not None:
                        yield close()
                    group, packers = g, {k: Packer(c) for k, c in capacities.items()}
                for pack_id, p in packers.items():
                    piece, left = 0, n
                    while left > p.capacity:
                        out.append((pack_id, g, p.put(p.capacity), 0, doc, piece, p.capacity))
                        piece, left = piece + 1, left - p.capacity
                    out.append((pack_id, g, p.put(left), 0, doc, piece, left))
            yield pd.DataFrame(out, columns=["pack_id", "grp", "bin", "used", "doc_id", "piece", "tokens"])
        if group is not None:
            yield close()

    return pack


def _merge(capacities: dict[int, int]):
    """Best-fit of open containers, as items of their used space, into containers of the next level."""

    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, p = None, None
        for pdf in parts:
            out = []
            for pack_id, up, name, used in zip(pdf["pack_id"], pdf["up"], pdf["name"], pdf["used"], strict=True):
                if (pack_id, up) != key:
                    if p is not None:
                        yield pd.DataFrame([(key[0], key[1], None, b, u) for b, u in p.still_open().items()], columns=["pack_id", "up", "name", "bin", "used"])
                    key, p = (pack_id, up), Packer(capacities[pack_id])
                out.append((pack_id, up, name, p.put(used), -1))
            yield pd.DataFrame(out, columns=["pack_id", "up", "name", "bin", "used"])
        if p is not None:
            yield pd.DataFrame([(key[0], key[1], None, b, u) for b, u in p.still_open().items()], columns=["pack_id", "up", "name", "bin", "used"])

    return merge


def pack(items: DataFrame, capacities: dict[int, int], group: int = GROUP) -> DataFrame:
    """(pack_id, bin_id, doc_id, piece, tokens): every item of (doc_id, tokens) once for each capacity.

    An item larger than the capacity comes as pieces 0, 1, ... of which all but the last fill a container. An item of no
    tokens takes a place too; a null size is left out. Ties (equal free space) go to the container opened last, so
    the same items give the same containers. No items give no rows.
    """
    spark = items.sparkSession
    items = cut(items.where("doc_id is not null and tokens is not null").select("doc_id", "tokens"))
    key = items.schema["doc_id"].dataType.simpleString()
    n = items.count()
    groups = max(1, -(-n // group))
    h = F.xxhash64("doc_id")
    dealt = items.select("doc_id", "tokens", F.pmod(h, F.lit(groups)).cast("int").alias("grp"), h.alias("h"))
    dealt = dealt.repartition(groups, "grp").sortWithinPartitions("grp", "h", "doc_id").select("doc_id", "grp", "tokens")
    shape = f"pack_id int, grp int, bin long, used long, doc_id {key}, piece int, tokens long"
    packed = cut(dealt.mapInPandas(_first(capacities), shape))
    name = lambda level: F.concat_ws("-", F.lit(level), "pack_id", "grp", "bin")
    placed = packed.where("piece >= 0").withColumn("name", name(0))
    opened = packed.where("piece < 0").select("pack_id", "grp", name(0).alias("name"), "used")
    moves, level = None, 0
    while groups > 1:
        level += 1
        groups = -(-groups // FAN)
        met = opened.select("pack_id", F.expr(f"grp div {FAN}").cast("int").alias("up"), "name", "used")
        # the largest first; at most FAN x OPEN containers of a capacity meet in one group
        met = met.repartition("pack_id", "up").sortWithinPartitions("pack_id", "up", F.desc("used"), "name")
        merged = cut(met.mapInPandas(_merge(capacities), "pack_id int, up int, name string, bin long, used long").withColumnRenamed("up", "grp"))
        step = merged.where("name is not null").select("name", name(level).alias("next"))
        opened = merged.where("name is null").select("pack_id", "grp", name(level).alias("name"), "used")
        moves = step if moves is None else moves.join(step.toDF("next", "then"), "next", "left").select("name", F.coalesce("then", "next").alias("next"))
    if moves is None:
        moves = spark.createDataFrame([], "name string, next string")
    # container names are short and their items at most the capacity, but for items of no tokens, which spread by name and id
    out = placed.join(moves, "name", "left")
    return out.select("pack_id", F.coalesce("next", "name").alias("bin_id"), "doc_id", "piece", "tokens")


def _capacities(spark: SparkSession, d: str) -> dict[int, int]:
    """The table has a fixed handful of rows."""
    return {r["pack_id"]: r["capacity_tokens"] for r in table(spark, d, "pack_sizes", "pack_id", "capacity_tokens").where("pack_id is not null and capacity_tokens > 0").collect()}


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(token_counts(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text"), _capacities(spark, d))


def p8_bins(spark: SparkSession, d: str) -> DataFrame:
    """Every text's container for every capacity."""
    return _packed(spark, d)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """For each capacity its containers, tokens and the share of room that is filled."""
    cap = table(spark, d, "pack_sizes", "pack_id", "capacity_tokens")
    bins = _packed(spark, d).groupBy("pack_id", "bin_id").agg(F.sum("tokens").alias("used"), F.count("*").alias("items"))
    per = bins.groupBy("pack_id").agg(F.count("*").alias("bins"), F.sum("items").alias("pieces"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return per.join(cap, "pack_id").select("pack_id", "capacity_tokens", "bins", "pieces", "tokens", "fullest", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")), 6).alias("filled"))


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """For each capacity: texts placed, bins over capacity, texts split though they fit, and whether 95 % of the room but one bin's is filled."""
    cap = table(spark, d, "pack_sizes", "pack_id", "capacity_tokens")
    placed = cut(_packed(spark, d)).join(F.broadcast(cap), "pack_id")  # a row for each capacity
    texts = placed.groupBy("pack_id", "doc_id", "capacity_tokens").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    per = texts.groupBy("pack_id").agg(F.count("*").alias("texts"), F.sum(((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).cast("long")).alias("split"), F.sum("tokens").alias("all"))
    bins = placed.groupBy("pack_id", "bin_id", "capacity_tokens").agg(F.sum("tokens").alias("used"))
    room = bins.groupBy("pack_id", "capacity_tokens").agg(F.sum((F.col("used") > F.col("capacity_tokens")).cast("long")).alias("over"), F.count("*").alias("bins"))
    filled = F.col("all") >= 0.95 * (F.col("bins") - 1) * F.col("capacity_tokens")
    return per.join(room, "pack_id").select("pack_id", "texts", "over", "split", filled.alias("filled"))


def queries() -> dict:
    return {"p8_bins": p8_bins, "p8_fill": p8_fill, "p8_invariants": p8_invariants}


def oracle_sql() -> dict[str, str]:
    return {
        "p8_invariants": """SELECT pack_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS texts,
            CAST(0 AS BIGINT) AS over, CAST(0 AS BIGINT) AS split, true AS filled FROM pack_sizes WHERE pack_id IS NOT NULL AND capacity_tokens > 0"""
    }
