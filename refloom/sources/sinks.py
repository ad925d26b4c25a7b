"""Sinks: versioned exports with provenance, content hashes, upserted and appended ledgers, reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom import __version__
from refloom.operators.edges import latest

SCHEMA_VERSION = "1.0"
#: Columns that differ between equal runs (fixed values).
VOLATILE = ("generated_at", "run_id", "duration_ms", "fetched_at")


def content_hash(rows: DataFrame) -> Column:
    """SHA-256 of a row's columns as JSON in the order of their names, without the volatile ones and nulls."""
    cols = sorted(c for c in rows.columns if c not in VOLATILE)
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def canonical_json(obj: object) -> str:
    return json.dumps(obj, sort_keys=True, indent=2, ensure_ascii=False) + "\n"


def provenance(rows: DataFrame, command: str, inputs: dict[str, str]) -> DataFrame:
    """One row: what wrote a table, from which inputs (name: hash), when."""
    spark = rows.sparkSession
    hashes = json.dumps(dict(sorted(inputs.items())))
    return spark.range(1).select(F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit("refloom").alias("generator"), F.lit(__version__).alias("version"), F.lit(command).alias("command"), F.lit(hashes).alias("input_hashes"), F.current_timestamp().alias("generated_at"))


def export(tables: dict[str, DataFrame], path: str, command: str, inputs: dict[str, str] | None = None, fmt: str = "parquet") -> None:
    """Each table below `path` with a table of its provenance beside it. A table appears whole or not at all."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
        provenance(df, command, inputs or {}).write.mode("overwrite").json(f"{path}/_meta/{name}")


def append(rows: DataFrame, path: str) -> None:
    """Append to a log."""
    rows.write.mode("append").parquet(path)


def upserted(log: DataFrame, key: str, *order: str) -> DataFrame:
    """The table that an append-only log stands for: the last row of each key."""
    return latest(log, key, *order)


def report(summary: DataFrame, title: str, most: int = 1000) -> tuple[list[str], str]:
    """(JSON lines, Markdown) of a small summary; at most `most` rows are shown, and the text says so."""
    rows = summary.limit(most + 1).toPandas()
    cut = len(rows) > most
    rows = rows.head(most)
    head = "| " + " | ".join(rows.columns) + " |"
    body = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.itertuples(index=False)]
    text = "\n".join([f"# {title}", "", head, "|" + " --- |" * len(rows.columns), *body, *([f"(first {most} rows)"] if cut else []), ""])
    return [json.dumps(r, default=str, sort_keys=True) for r in rows.to_dict("records")], text
