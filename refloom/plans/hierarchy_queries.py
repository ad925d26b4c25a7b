"""Queries over `dependencies` that turn its links into hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators import hierarchy as H
from refloom.sources.tables import table

_LINKS = """
RECURSIVE l AS (
  SELECT DISTINCT from_node AS parent, to_node AS child FROM dependencies
  WHERE from_node IS NOT NULL AND to_node IS NOT NULL
    AND lower(trim(edge_type)) IN ('prerequisite', 'conditional', 'orientation', 'historical')
), one AS (SELECT child, min(parent) AS parent FROM l GROUP BY child),
up AS (
  SELECT child AS node, parent AS above FROM one
  UNION SELECT up.node, one.parent FROM up JOIN one ON one.child = up.above
), ring AS (SELECT node FROM up WHERE node = above),
roots AS (SELECT DISTINCT parent AS node FROM one WHERE parent NOT IN (SELECT child FROM one)),
walk AS (
  SELECT node, node AS root, 0 AS depth, node AS path FROM roots
  UNION ALL SELECT one.child, walk.root, walk.depth + 1, walk.path || ' > ' || one.child FROM walk JOIN one ON one.parent = walk.node
)"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return H.links(table(spark, d, "dependencies", "from_node", "to_node", "edge_type"), "from_node", "to_node", "edge_type")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return H.found(_pairs(spark, d))


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    tree = H.cut(H.hierarchy(_pairs(spark, d)))
    named = H.paths(tree)
    return named.join(tree, "node_id").select("node_id", "root_id", "depth", F.array_join("path", " > ").alias("path"), "descendants")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    """One row for each node and each node below it: as long as all paths together."""
    named = H.paths(H.cut(H.hierarchy(_pairs(spark, d))))
    pairs = named.select(F.col("node_id").alias("descendant_id"), F.posexplode("path").alias("at", "node_id"), (F.size("path") - 1).alias("deep"))
    return pairs.where("at < deep").select("node_id", "descendant_id", (F.col("deep") - F.col("at")).alias("distance"))


def p4_cycles(spark: SparkSession, d: str) -> DataFrame:
    """The nodes on cycles, each with its successor on it."""
    h = H.hierarchy(_pairs(spark, d)).where("status = 'cycle'")
    return h.select("node_id", F.col("parent_id").alias("previous_id"))


def p4_other_parents(spark: SparkSession, d: str) -> DataFrame:
    """The links left out because their node has a smaller parent."""
    return H.other_parents(_pairs(spark, d))


def queries() -> dict:
    return {"p4_other_parents": p4_other_parents, "p4_found": p4_found, "p4_paths": p4_paths, "p4_descendants": p4_descendants, "p4_cycles": p4_cycles}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": f"""WITH {_LINKS}
            SELECT node AS node_id, root AS root_id, CAST(depth AS INTEGER) AS depth FROM walk
            UNION ALL SELECT child, '-', CASE WHEN child IN (SELECT node FROM ring) THEN -1 ELSE -2 END FROM one
            WHERE child NOT IN (SELECT node FROM walk)""",
        "p4_paths": f"""WITH {_LINKS}
            SELECT node AS node_id, root AS root_id, CAST(depth AS INTEGER) AS depth, path,
              (SELECT count(*) FROM up WHERE up.above = walk.node) AS descendants FROM walk""",
        "p4_descendants": f"""WITH {_LINKS}
            SELECT a.node AS node_id, b.node AS descendant_id, CAST(b.depth - a.depth AS INTEGER) AS distance
            FROM up JOIN walk a ON a.node = up.above JOIN walk b ON b.node = up.node""",
        "p4_other_parents": f"WITH {_LINKS} SELECT l.parent, l.child FROM l JOIN one USING (child) WHERE l.parent <> one.parent",
        "p4_cycles": f"WITH {_LINKS} SELECT child AS node_id, parent AS previous_id FROM one WHERE child IN (SELECT node FROM ring)",
    }
