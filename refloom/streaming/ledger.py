"""Structured Streaming: the ledger's incremental operators and windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from refloom.operators.edges import latest


def fresh(stream: DataFrame, keys: list[str], at: str, late: str = "1 day") -> DataFrame:
    """Rows whose keys were not seen within the watermark: an asset fetched again with the same content is skipped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, at: str, size: str, late: str, *by: str) -> DataFrame:
    """Counts by window of event time and other columns; late rows beyond the watermark are dropped by the engine."""
    w = stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *by).agg(F.count("*").alias("events"))
    return w.select(F.col("w.start").alias("start"), *by, "events")


def sessions(stream: DataFrame, at: str, gap: str, late: str, by: str) -> DataFrame:
    """Sessions of a key: rows no further apart than `gap`."""
    s = stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), by).agg(F.count("*").alias("events"))
    return s.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def upsert_into(path: str, key: str, *order: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch adds its last row of every key; `current` reads the table."""

    def write(batch: DataFrame, epoch: int) -> None:
        latest(batch, key, *order).withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def current(spark, path: str, key: str, *order: str) -> DataFrame:
    """The last row of every key over all batches; a batch written twice counts once, so the sink is exactly-once."""
    return latest(spark.read.parquet(path).drop("epoch", "_epoch"), key, *order)


def to_memory(df: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    return df.writeStream.format("memory").queryName(name).outputMode(mode).start()
