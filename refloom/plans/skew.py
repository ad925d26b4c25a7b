"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most this many keys can each hold more than 1/HEAVY of the rows, which bounds what is broadcast.
HEAVY = 1000


def heavy_keys(counts: DataFrame, key: str, n: str, total: int, parts: int = HEAVY) -> DataFrame:
    """The keys that hold more than one part in `parts` of `total` rows: fewer than `parts` by construction."""
    return counts.where(F.col(n) * F.lit(parts) > F.lit(total)).select(key)


def lookup(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """Join `rows` with `table`, whose `key` is unique, without sending a heavy key's rows to one task.

    `heavy` holds the heavy keys (see `heavy_keys`, so it has a proven bound). Their table rows are broadcast and
    their own rows are scattered by a salt; all others meet in a shuffled join. Null keys match nothing.
    """
    values = [c for c in table.columns if c != key]
    packed = table.select(F.col(key).alias("_k"), F.struct(*values).alias("_v"))
    hot = packed.join(F.broadcast(heavy.select(F.col(key).alias("_k")).distinct()), "_k", "left_semi")
    cold = packed.withColumnRenamed("_v", "_c")
    left = rows.join(F.broadcast(hot), rows[key] == hot["_k"], "left").drop("_k")
    # an unmatched join key that spreads: the heavy rows already carry their value, null keys match nothing
    spread: Column = F.concat(F.lit("\u0000"), F.expr("uuid()"))
    free = F.col("_v").isNotNull() | F.col(key).isNull()
    left = left.withColumn("_j", F.when(free, spread).otherwise(F.col(key).cast("string")))
    cold = cold.withColumn("_k", F.col("_k").cast("string"))
    out = left.join(cold, left["_j"] == cold["_k"], "left").withColumn("_v", F.coalesce("_v", "_c"))
    if how == "inner":
        out = out.where(F.col("_v").isNotNull())
    return out.select(*rows.columns, *[F.col("_v")[c].alias(c) for c in values])
