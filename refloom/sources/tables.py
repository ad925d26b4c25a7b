"""Parquet table scans by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table `name` of the directory, with only `columns` when some are given.

    Naming the columns here keeps them in the scan's read schema whatever the operator does later.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
