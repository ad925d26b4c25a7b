"""Rule tables: every rule is a filter, an anti-join or a count that gives issues (severity, code, location)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Controlled vocabularies (fixed values).
WORK_TYPES = ("article", "book", "notes", "sequence", "web_page", "collection")
ACCESS = ("open", "preview", "borrow", "purchase", "institutional", "unknown")
TITLE_STATUS, METADATA_STATUS = ("present", "unknown"), ("verified", "unverified")
EDGE_TYPES = ("prerequisite", "backup", "validates", "conditional", "orientation", "historical")

_SHAPE = ("severity", "code", "location")


def issue(rows: DataFrame, severity: str, code: str, location: Column) -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), location.cast("string").alias("location"))


def rule(rows: DataFrame, broken: Column, severity: str, code: str, location: Column) -> DataFrame:
    """Rows for which `broken` holds; a rule that cannot be told (null) is not broken."""
    return issue(rows.where(F.coalesce(broken, F.lit(False))), severity, code, location)


def repeated(rows: DataFrame, key: str, severity: str, code: str) -> DataFrame:
    return issue(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1"), severity, code, F.col(key))


def dangling(rows: DataFrame, key: str, known: DataFrame, severity: str, code: str) -> DataFrame:
    """Keys without a row in `known` (its first column), each once."""
    keys = rows.select(F.col(key).alias("k")).where("k is not null").distinct()
    return issue(keys.join(known.select(F.col(known.columns[0]).alias("k")).distinct(), "k", "left_anti"), severity, code, F.col("k"))


def all_issues(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(issues: DataFrame) -> bool:
    """Whether no issue is an error."""
    return issues.where("severity = 'error'").isEmpty()


def corpus_issues(works: DataFrame) -> DataFrame:
    """The rules of a corpus table (work_id, aliases, title, title_status, work_type, metadata_status, access_state, identifiers)."""
    w = works.select("work_id", "aliases", "title", "title_status", "work_type", "metadata_status", "access_state", "identifiers")
    at = F.col("work_id")
    blank = F.trim(F.coalesce("title", F.lit(""))) == ""
    alias = w.select("work_id", F.explode("aliases").alias("alias")).distinct()
    return all_issues(
        repeated(w.select("work_id", "title", "work_type").distinct(), "work_id", "error", "duplicate-work-id"),
        rule(w, F.coalesce(F.size("aliases"), F.lit(0)) <= 0, "error", "missing-alias", at),
        repeated(alias, "alias", "error", "duplicate-alias"),
        rule(w, ~F.col("work_type").isin(*WORK_TYPES), "error", "bad-work-type", at),
        rule(w, ~F.col("metadata_status").isin(*METADATA_STATUS), "error", "bad-metadata-status", at),
        rule(w, ~F.col("title_status").isin(*TITLE_STATUS), "error", "bad-title-status", at),
        rule(w, (F.col("title_status") == "present") & blank, "error", "empty-title", at),
        rule(w, (F.col("metadata_status") == "verified") & (F.col("title_status") != "present"), "error", "unverifiable-metadata", at),
        rule(w, F.col("metadata_status") == "unverified", "warning", "unverified-work", at),
        rule(w, ~F.col("access_state").isin(*ACCESS), "error", "bad-access", at),
        rule(w, F.exists(F.map_values("identifiers"), lambda v: v.isNull() | (v == "")), "error", "empty-identifier", at),
    ).distinct()


def dependency_issues(edges: DataFrame, cycles: DataFrame) -> DataFrame:
    """The rules of links (from_node, to_node, edge_type), with the nodes on cycles of ordering links."""
    e = edges.select("from_node", "to_node", F.lower(F.trim("edge_type")).alias("kind"))
    at = F.concat_ws(">", "from_node", "to_node", "kind")
    known = e.where("from_node is not null and to_node is not null")
    return all_issues(
        rule(e, ~F.col("kind").isin(*EDGE_TYPES), "error", "bad-edge-type", at),
        rule(e, F.col("from_node").isNull() | F.col("to_node").isNull(), "error", "dangling-edge-endpoint", at),
        rule(known, F.col("from_node") == F.col("to_node"), "error", "self-edge", at),
        issue(known.groupBy("from_node", "to_node", "kind").agg(F.count("*").alias("n")).where("n > 1"), "error", "duplicate-edge", at),
        issue(cycles, "error", "dependency-cycle", F.col("node")),
    ).distinct()
