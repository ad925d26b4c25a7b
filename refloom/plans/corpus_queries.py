"""Queries over manifests, references and discovered works, beside the SQL that gives the same rows.

What the test tables have no columns for (assets, rights, nodes, choices, built pages) is asked on small written tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions import bibliographic as B
from refloom.operators import edges as E
from refloom.operators import manifest_rules as M
from refloom.operators import rank as R
from refloom.operators import resolve as RS
from refloom.plans import catalogue as C
from refloom.plans.materialize import cut
from refloom.sources.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _refs(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "parsed_refs", "ref_id", *cols).where("ref_id is not null").dropDuplicates(["ref_id"])


# --- reference strings -------------------------------------------------------------------------------------------------

_MARK = "'^\\s*(?:\\[\\d{1,3}\\]|\\(\\d{1,3}\\)|\\d{1,3}\\.)\\s*'"
_REF = "r AS (SELECT DISTINCT ON (ref_id) ref_id, raw FROM parsed_refs WHERE ref_id IS NOT NULL AND raw IS NOT NULL ORDER BY ref_id)"


@query(
    f"""WITH RECURSIVE {_REF}, a AS (
      SELECT ref_id, 0 AS k, CAST(NULL AS VARCHAR) AS name, regexp_replace(raw, {_MARK}, '') AS rest FROM r
      UNION ALL SELECT ref_id, k + 1, CASE WHEN k = 0 THEN regexp_extract(rest, '{B.FIRST_NAME}', 1) ELSE regexp_extract(rest, '{B.NEXT_NAME}', 1) END,
        substr(rest, length(CASE WHEN k = 0 THEN regexp_extract(rest, '{B.FIRST_NAME}') ELSE regexp_extract(rest, '{B.NEXT_NAME}') END) + 1) FROM a
        WHERE CASE WHEN k = 0 THEN regexp_matches(rest, '{B.FIRST_NAME}') ELSE regexp_matches(rest, '{B.NEXT_NAME}') END)
    SELECT ref_id, CAST(k - 1 AS INTEGER) AS position, trim(regexp_replace(name, ',\\s*', ', ')) AS name FROM a WHERE k > 0"""
)
def reference_authors(spark: SparkSession, d: str) -> DataFrame:
    """The names at the beginning of each reference string, in order."""
    r = _refs(spark, d, "raw").where("raw is not null")
    return r.select("ref_id", F.posexplode(B.reference_authors(F.col("raw"))).alias("position", "name"))


@query(
    f"""WITH {_REF}, i AS (SELECT ref_id, nullif(regexp_replace(upper(regexp_extract(raw, '{B.MARKED_ISBN}', 1)), '[\\s-]', '', 'g'), '') AS s FROM r)
    SELECT ref_id, CASE WHEN regexp_full_match(s, '\\d{{13}}') AND list_sum(list_transform(range(1, 14), lambda k: TRY_CAST(substr(s, k, 1) AS INTEGER) * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10 = 0 THEN s END AS isbn,
      s IS NOT NULL AS shaped FROM i"""
)
def reference_isbns(spark: SparkSession, d: str) -> DataFrame:
    """The ISBN of each reference string, and whether something of its shape stands there: shaped without a value failed its checksum."""
    r = _refs(spark, d, "raw").where("raw is not null")
    return r.select("ref_id", B.parsed_reference(F.col("raw")).alias("p"), B.isbn_shaped(F.col("raw")).alias("shaped")).select("ref_id", "p.isbn", "shaped")


# --- resolved and discovered works -------------------------------------------------------------------------------------

_RESOLVED = C._SQL["resolve_references"].strip()
_REFKEY = f"""x AS (SELECT DISTINCT ON (ref_id) * FROM parsed_refs WHERE ref_id IS NOT NULL ORDER BY ref_id),
s AS ({_RESOLVED}),
y AS (SELECT x.ref_id, x.citing_work_id, x.ref_index, x.raw, x.title, x.year, s.status, s.score, {C._DOI.format("x.doi")} AS d, {C._key("x.title")} AS t,
  {C._key("(" + C._surname("x.authors[1]") + ")")} AS who,
  CASE WHEN regexp_full_match(regexp_replace(x.isbn, '[\\s-]', '', 'g'), '\\d{{13}}') AND list_sum(list_transform(range(1, 14), lambda k: TRY_CAST(substr(regexp_replace(x.isbn, '[\\s-]', '', 'g'), k, 1) AS INTEGER) * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10 = 0
    THEN regexp_replace(x.isbn, '[\\s-]', '', 'g') END AS i FROM x JOIN s USING (ref_id)),
z AS (SELECT *, coalesce('doi:' || d, 'isbn:' || i, 'local:' || sha256({C._key("concat_ws('|', who, coalesce(title, ''), coalesce(CAST(year AS VARCHAR), 'None'))")})) AS target FROM y WHERE status = 'discovered')"""


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    """Every reference with its resolution."""
    rows = _refs(spark, d, "citing_work_id", "ref_index", "raw", "title", "year", "doi", "isbn", "authors")
    found = RS.resolve(rows, table(spark, d, "corpus", "work_id", "title", "year", "authors", "identifiers"))
    return rows.join(found.select("ref_id", "status", "target_id", "score"), "ref_id")


@query(
    f"""WITH {_REFKEY} SELECT target AS id, arg_min(coalesce(title, ''), (coalesce(citing_work_id, ''), coalesce(ref_index, -1), ref_id)) AS title, CAST(arg_min(coalesce(year, -1), (coalesce(citing_work_id, ''), coalesce(ref_index, -1), ref_id)) AS INTEGER) AS year,
    coalesce(string_agg(DISTINCT citing_work_id, ' ' ORDER BY citing_work_id), '') AS cited_by, CAST(count(DISTINCT raw) AS BIGINT) AS raw_references FROM z GROUP BY target"""
)
def discovered_works(spark: SparkSession, d: str) -> DataFrame:
    """What references cite that no table knows: title and year of the first reference, who cites it, how it is written."""
    z = _resolved(spark, d).where("status = 'discovered'")
    first = F.struct(F.coalesce("citing_work_id", F.lit("")), F.coalesce("ref_index", F.lit(-1)), "ref_id")
    return z.groupBy(F.col("target_id").alias("id")).agg(
        F.min_by(F.coalesce("title", F.lit("")), first).alias("title"), F.min_by(F.coalesce("year", F.lit(-1)), first).alias("year"),
        F.array_join(F.array_sort(F.collect_set("citing_work_id")), " ").alias("cited_by"), F.countDistinct("raw").alias("raw_references"),
    )


@query(
    f"""WITH {_REFKEY}, m AS (SELECT citing_work_id, target, raw, 0.0 AS score FROM z
      UNION ALL SELECT y.citing_work_id, b.work, y.raw, y.score FROM y JOIN (SELECT DISTINCT ON (q.ref_id) q.ref_id, w.work_id AS work FROM y q JOIN (SELECT DISTINCT ON (work_id) * FROM corpus ORDER BY work_id) w
        ON {C._key("w.title")} = q.t AND w.year = q.year AND list_contains(list_transform(w.authors, lambda a: {C._key("(" + C._surname("a") + ")")}), q.who) WHERE q.status = 'resolved' ORDER BY q.ref_id, w.work_id) b USING (ref_id) WHERE y.status = 'resolved')
    SELECT citing_work_id AS source, target, CAST(count(*) AS BIGINT) AS weight, CAST(count(DISTINCT raw) AS BIGINT) AS raw_references, CAST(max(score) AS DOUBLE) AS confidence,
      CASE WHEN max(score) > 0 THEN 'resolution' ELSE 'discovery' END AS method FROM m WHERE citing_work_id IS NOT NULL GROUP BY ALL"""
)
def citations_with_discovered(spark: SparkSession, d: str) -> DataFrame:
    """Citations built from references: resolved ones and, with confidence 0, those of discovered works."""
    m = _resolved(spark, d).where("status in ('resolved', 'discovered') and citing_work_id is not null")
    m = m.withColumn("score", F.when(F.col("status") == "resolved", F.col("score")).otherwise(0.0))
    one = m.groupBy(F.col("citing_work_id").alias("source"), F.col("target_id").alias("target")).agg(F.count("*").alias("weight"), F.countDistinct("raw").alias("raw_references"), F.max("score").alias("confidence"))
    return one.withColumn("method", F.when(F.col("confidence") > 0, "resolution").otherwise("discovery"))


_MERGE = f"""{C._DISC}, k AS (SELECT discovered_id AS id, doi, isbn, cited_by, {C._MKEY} AS key FROM disc),
b AS (SELECT key, arg_min(id, (doi IS NULL, isbn IS NULL, id)) AS best FROM k WHERE key IS NOT NULL GROUP BY key),
al AS (SELECT id, doi, isbn, cited_by, coalesce(best, id) AS canonical_id FROM k LEFT JOIN b USING (key))"""


@query(
    f"""WITH {_MERGE}, cb AS (SELECT DISTINCT canonical_id, unnest(cited_by) AS c FROM al),
    l AS (SELECT canonical_id, string_agg(c, ' ' ORDER BY c) AS cited_by FROM cb WHERE c IS NOT NULL GROUP BY 1)
    SELECT canonical_id AS id, arg_min(doi, (id <> canonical_id, isbn IS NULL, id)) FILTER (doi IS NOT NULL) AS doi, arg_min(isbn, (id <> canonical_id, doi IS NULL, id)) FILTER (isbn IS NOT NULL) AS isbn,
      coalesce(any_value(l.cited_by), '') AS cited_by, coalesce(string_agg(id, ' ' ORDER BY id) FILTER (id <> canonical_id), '') AS merged_from FROM al LEFT JOIN l USING (canonical_id) GROUP BY canonical_id"""
)
def merged_discovered(spark: SparkSession, d: str) -> DataFrame:
    """Discovered works merged by title, year and first surname: lists united, the first DOI and ISBN, what was merged."""
    rec = table(spark, d, "discovered", "discovered_id", "title", "authors", "year", "doi", "isbn", "cited_by").withColumnRenamed("discovered_id", "id")
    return E.merged_records(rec)


@query(
    f"""WITH {_MERGE}, p AS (SELECT unnest(cited_by) AS source, canonical_id AS target, id FROM al)
    SELECT source, target, CAST(count(DISTINCT id) AS BIGINT) AS weight FROM p WHERE source IS NOT NULL GROUP BY ALL"""
)
def promoted_citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations of discovered works, with the ids that merging gave them."""
    rec = table(spark, d, "discovered", "discovered_id", "title", "authors", "year", "doi", "isbn", "cited_by").withColumnRenamed("discovered_id", "id")
    return E.promoted(rec, E.merge_records(rec))


@query(
    f"""WITH {C._COUPLING} SELECT c.a, c.b, x.target AS shared FROM c JOIN e x ON x.source = c.a JOIN e y ON y.source = c.b AND y.target = x.target"""
)
def coupling_evidence(spark: SparkSession, d: str) -> DataFrame:
    """What each coupled pair shares, a row for each target."""
    e = cut(table(spark, d, "citation_edges", "source", "target").where("source is not null and target is not null").distinct())
    pairs = E.shared_pairs(e, "source", "target").select("a", "b")
    mine = pairs.join(e.toDF("a", "shared"), "a")
    return mine.join(e.toDF("b", "shared"), ["b", "shared"], "left_semi").select("a", "b", "shared")


@query(
    f"""WITH RECURSIVE {C._COUPLING}, v AS (SELECT a AS x, b AS y FROM c WHERE cosine >= 0.2 UNION SELECT b, a FROM c WHERE cosine >= 0.2),
    reach AS (SELECT x AS node, x AS reached FROM v UNION SELECT reach.node, v.y FROM reach JOIN v ON v.x = reach.reached), m AS (SELECT node, min(reached) AS component FROM reach GROUP BY node),
    q AS (SELECT m.component, c.a, c.b, c.cosine, row_number() OVER (PARTITION BY m.component ORDER BY c.cosine DESC, c.a, c.b) AS place FROM c JOIN m ON m.node = c.a WHERE c.cosine >= 0.2)
    SELECT component, a, b, cosine, CAST(place AS INTEGER) AS place FROM q WHERE place <= 10"""
)
def cluster_strongest(spark: SparkSession, d: str) -> DataFrame:
    """The ten strongest pairs of each cluster. Each bucket of rows gives its ten best, so a giant cluster fits no single task's window."""
    c = cut(C.coupling(spark, d).where("cosine >= 0.2").select("a", "b", "cosine"))
    m = C.components(c, "a", "b").toDF("a", "component")
    rows = c.join(m, "a").withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(64)))
    place = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.desc("cosine"), "a", "b"))
    few = rows.withColumn("place", place("component", "bucket")).where("place <= 10")
    return few.withColumn("place", place("component")).where("place <= 10").select("component", "a", "b", "cosine", "place")


_TEAM = f"""w AS (SELECT DISTINCT ON (work_id) work_id, authors, aliases FROM corpus WHERE work_id IS NOT NULL ORDER BY work_id),
a AS (SELECT work_id, lower(name) AS author, name, team, grp FROM (SELECT work_id, len(list_filter(authors, lambda x: x IS NOT NULL)) AS team, unnest(authors) AS name, nullif(upper(regexp_extract(aliases[1], '^([A-Za-z]+)', 1)), '') AS grp FROM w) WHERE name IS NOT NULL),
i AS (SELECT target, count(*) AS indegree FROM e GROUP BY target),
co AS (SELECT x.author, count(DISTINCT y.author) AS coauthors FROM a x JOIN a y ON x.work_id = y.work_id AND x.author <> y.author GROUP BY x.author),
best AS (SELECT node FROM s ORDER BY {C._BY} LIMIT 10)"""


@query(
    f"""WITH {C._DIMS}, {C._SCORED}, {_TEAM}
    SELECT a.author, string_agg(DISTINCT a.name, '; ' ORDER BY a.name) AS display_names, CAST(count(DISTINCT a.work_id) AS BIGINT) AS works, round(sum(coalesce(i.indegree, 0) / a.team), 4) AS credit, CAST(count(DISTINCT a.grp) AS BIGINT) AS seed_groups,
      round(coalesce(sum(1.0::DOUBLE / a.team) FILTER (a.work_id IN (SELECT node FROM best)), 0), 4) AS top_contribution, CAST(coalesce(any_value(co.coauthors), 0) AS BIGINT) AS coauthors, 0.5::DOUBLE AS identity_confidence, 'normalized-name' AS identity_basis
    FROM a LEFT JOIN i ON i.target = a.work_id LEFT JOIN co ON co.author = a.author GROUP BY a.author"""
)
def author_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Authors by name as written, without case: credit, groups, share in the ten best works, identity."""
    a = E.authorship(table(spark, d, "corpus", "work_id", "authors"), "work_id", "authors", 0.5, "normalized-name").withColumn("author", F.lower("name"))
    g = C._works(spark, d, "aliases").select(F.col("work_id").alias("work"), B.seed_group(F.get("aliases", F.lit(0))).alias("grp"))
    dims = C._dims(spark, d)
    best = R.top(R.scored(dims).select("node", "indegree", "score"), 10).select(F.col("node").alias("work"))
    return R.author_ranking(a, dims.select(F.col("node").alias("target"), "indegree"), g, best)


@query(
    """WITH d AS (SELECT work_id, doc_id, section, n_chars FROM documents WHERE work_id IS NOT NULL)
    SELECT work_id, arg_min(doc_id, (section IS DISTINCT FROM 'fulltext', section IS DISTINCT FROM 'abstract', doc_id)) AS doc_id, arg_min(coalesce(section, '-'), (section IS DISTINCT FROM 'fulltext', section IS DISTINCT FROM 'abstract', doc_id)) AS section FROM d GROUP BY work_id"""
)
def best_documents(spark: SparkSession, d: str) -> DataFrame:
    """The best text of each work: the full text, else the abstract, else any; of several the smallest id."""
    rows = table(spark, d, "documents", "work_id", "doc_id", "section").where("work_id is not null")
    other = lambda s: ~F.coalesce(F.col("section") == s, F.lit(False))
    order = F.struct(other("fulltext").alias("f"), other("abstract").alias("a"), "doc_id")
    return rows.groupBy("work_id").agg(F.min_by("doc_id", order).alias("doc_id"), F.min_by(F.coalesce("section", F.lit("-")), order).alias("section"))


@query(
    """WITH h AS (SELECT page_id, block_no, text, heading_level FROM page_blocks WHERE kind = 'heading')
    SELECT page_id, block_no, nullif(regexp_extract(text, '^(\\d+(?:\\.\\d+)*)\\.?\\s+\\S', 1), '') AS number, trim(regexp_replace(text, '^\\d+(?:\\.\\d+)*\\.?\\s+', '')) AS title, heading_level AS level, 0.95::DOUBLE AS confidence FROM h"""
)
def block_headings(spark: SparkSession, d: str) -> DataFrame:
    """The headings of pages with their number, title and level."""
    h = table(spark, d, "page_blocks", "page_id", "block_no", "kind", "text", "heading_level").where("kind = 'heading'")
    number = F.nullif(F.regexp_extract("text", r"^(\d+(?:\.\d+)*)\.?\s+\S", 1), F.lit(""))
    return h.select("page_id", "block_no", number.alias("number"), F.trim(F.regexp_replace("text", r"^\d+(?:\.\d+)*\.?\s+", "")).alias("title"), F.col("heading_level").alias("level"), F.lit(0.95).alias("confidence"))


@query("SELECT edge_type, CAST(count(*) AS BIGINT) AS edges FROM (SELECT DISTINCT source, target, edge_type FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL) GROUP BY edge_type UNION ALL SELECT 'works', CAST(count(DISTINCT work_id) AS BIGINT) FROM corpus UNION ALL SELECT 'discovered', CAST(count(DISTINCT discovered_id) AS BIGINT) FROM discovered UNION ALL SELECT 'references', CAST(count(DISTINCT ref_id) AS BIGINT) FROM parsed_refs")
def analysis_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts that head an export: edges by kind, works, discovered works, references."""
    e = table(spark, d, "citation_edges", "source", "target", "edge_type").where("source is not null and target is not null").distinct().groupBy("edge_type").agg(F.count("*").alias("edges"))
    n = lambda name, key, tag: table(spark, d, name, key).agg(F.countDistinct(key).alias("edges")).select(F.lit(tag).alias("edge_type"), "edges")
    return e.unionByName(n("corpus", "work_id", "works")).unionByName(n("discovered", "discovered_id", "discovered")).unionByName(n("parsed_refs", "ref_id", "references"))


# --- rules on written tables -------------------------------------------------------------------------------------------

_FIXTURES: dict[str, tuple[str, list[tuple]]] = {
    "f_rights": ("work_id string, publish_abstract boolean, publish_fulltext boolean, license_evidence_url string, local_storage_allowed boolean", [("w1", True, False, None, None), ("w2", False, True, "", True), ("w3", True, True, "https://l.example/by", False), ("w4", True, True, "https://l.example/by", True), ("w5", None, None, None, None)]),
    "f_members": ("work_id string, work_type string, alias string, member string, container string", [("c1", "collection", "COL", "S1", None), ("c2", "collection", "EMP", None, None), ("s1", "sequence", "S1", None, "COL"), ("s2", "sequence", "S2", "GONE", "NOWHERE"), ("a1", "article", "A1", None, "")]),
    "f_assets": ("work_id string, asset_id string, role string, intent string, url string, min_bytes int", [("w1", "x1", "fulltext", "required", "https://a.example/1", 10), ("w1", "x2", "landing", "required", "https://a.example/2", None), ("w2", "x1", "mirror", "fallback", "https://a.example/1", 0), ("w3", "x3", "poster", "manual", None, None), ("w3", "x4", "preview", "soon", "ftp://a.example/4", None), ("w4", "x5", None, "ignore", "", -1)]),
    "f_nodes": ("node_id string, kind string, ref string, option_a string, option_b string", [("n1", "work", "w1", None, None), ("n2", "work", None, None, None), ("n3", "collection", "GONE", None, None), ("n4", "choice", None, "n1", "n2"), ("n5", "choice", None, "n1", None), ("n6", "shelf", None, None, None), ("n7", "choice", None, "n1", "n99"), ("n6", "shelf", None, None, None), ("n8", "work", "B2", None, None)]),
    "f_works": ("work_id string, alias string", [("w1", "A1"), ("w2", "B2"), ("w3", "C3"), ("w4", None)]),
    "f_profile": ("choice_id string, selected string", [("n4", "n1"), ("n5", None), ("n99", "n1"), ("n4x", None)]),
    "f_pages": ("path string, title string, inline_scripts int", [("index.html", "Start", 0), ("a/one.html", " ", 1), ("a/two.html", "Two", 0)]),
    "f_links": ("path string, href string", [("index.html", "a/one.html"), ("index.html", "a/gone.html"), ("a/one.html", "two.html#top"), ("a/one.html", "two.html#none"), ("a/one.html", "../index.html"), ("a/two.html", "/index.html"), ("a/two.html", "javascript:void(0)"), ("a/two.html", "https://x.example/"), ("a/two.html", "#top"), ("a/two.html", "./one.html")]),
    "f_anchors": ("path string, anchor string", [("a/two.html", "top")]),
}


def _value(x: object, kind: str) -> str:
    sql = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}[kind]
    return f"CAST(NULL AS {sql})" if x is None else "'" + x + "'" if isinstance(x, str) else str(x)


def _values(name: str) -> str:
    shape, rows = _FIXTURES[name]
    cols, kinds = zip(*(c.split() for c in shape.split(", ")), strict=True)
    return f"{name}({', '.join(cols)}) AS (VALUES " + ", ".join("(" + ", ".join(_value(x, k) for x, k in zip(r, kinds, strict=True)) + ")" for r in rows) + ")"


def _written(spark: SparkSession, name: str) -> DataFrame:
    shape, rows = _FIXTURES[name]
    return spark.createDataFrame(rows, shape)


@query(
    f"""WITH {_values("f_rights")} SELECT 'error' AS severity, 'publish-without-evidence' AS code, work_id AS location FROM f_rights WHERE publish_fulltext AND coalesce(license_evidence_url, '') = ''
    UNION ALL SELECT 'error', 'publish-without-evidence', work_id FROM f_rights WHERE publish_abstract AND coalesce(license_evidence_url, '') = '' UNION ALL SELECT 'error', 'publish-without-storage', work_id FROM f_rights WHERE publish_fulltext AND NOT coalesce(local_storage_allowed, false)"""
)
def rights_rules(spark: SparkSession, d: str) -> DataFrame:
    return M.rights_issues(_written(spark, "f_rights"))


_PRESENT = lambda *cs: F.filter(F.array(*cs), lambda x: x.isNotNull())


@query(
    f"""WITH {_values("f_members")} SELECT 'error' AS severity, 'empty-collection' AS code, work_id AS location FROM f_members WHERE work_type = 'collection' AND member IS NULL
    UNION ALL SELECT 'error', 'dangling-member', work_id FROM f_members WHERE member IS NOT NULL AND member NOT IN (SELECT alias FROM f_members) UNION ALL SELECT 'error', 'dangling-container', work_id FROM f_members WHERE container <> '' AND container NOT IN (SELECT alias FROM f_members)
    UNION ALL SELECT 'error', 'missing-seed-alias', x FROM (VALUES ('COL'), ('R0')) t(x) WHERE x NOT IN (SELECT alias FROM f_members)"""
)
def membership_rules(spark: SparkSession, d: str) -> DataFrame:
    w = _written(spark, "f_members").select("work_id", "work_type", _PRESENT("alias").alias("aliases"), _PRESENT("member").alias("members"), "container")
    return M.membership_issues(w, spark.createDataFrame([("COL",), ("R0",)], "alias string"))


_ASSET_AT = "concat_ws('/', work_id, asset_id)"


@query(
    f"""WITH {_values("f_assets")}, n AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY work_id) AS ka, row_number() OVER (PARTITION BY url ORDER BY work_id, asset_id) AS ku FROM f_assets)
    SELECT 'error' AS severity, 'duplicate-asset-id' AS code, {_ASSET_AT} AS location FROM n WHERE ka > 1 UNION ALL SELECT 'warning', 'duplicate-url', {_ASSET_AT} FROM n WHERE ku > 1 AND url <> ''
    UNION ALL SELECT 'error', 'bad-role', {_ASSET_AT} FROM n WHERE coalesce(role, '') NOT IN ('landing', 'fulltext', 'metadata', 'mirror', 'preview', 'borrow') UNION ALL SELECT 'error', 'bad-intent', {_ASSET_AT} FROM n WHERE intent NOT IN ('required', 'fallback', 'metadata_only', 'manual', 'ignore')
    UNION ALL SELECT 'error', 'missing-url', {_ASSET_AT} FROM n WHERE intent <> 'ignore' AND coalesce(url, '') = '' UNION ALL SELECT 'error', 'bad-url-scheme', {_ASSET_AT} FROM n WHERE url <> '' AND NOT regexp_matches(url, '^https?://')
    UNION ALL SELECT 'error', 'bad-min-bytes', {_ASSET_AT} FROM n WHERE min_bytes < 1 UNION ALL SELECT 'error', 'required-non-content', {_ASSET_AT} FROM n WHERE intent = 'required' AND role NOT IN ('fulltext', 'metadata', 'mirror')"""
)
def asset_rules(spark: SparkSession, d: str) -> DataFrame:
    return M.asset_issues(_written(spark, "f_assets"))


@query(
    f"""WITH {_values("f_nodes")}, {_values("f_works")}, o AS (SELECT node_id, option_a AS o FROM f_nodes WHERE kind = 'choice' UNION ALL SELECT node_id, option_b FROM f_nodes WHERE kind = 'choice'), m AS (SELECT work_id AS x FROM f_works UNION SELECT alias FROM f_works WHERE alias IS NOT NULL)
    SELECT 'error' AS severity, 'duplicate-node' AS code, node_id AS location FROM f_nodes GROUP BY node_id HAVING count(*) > 1 UNION ALL SELECT 'error', 'bad-node-kind', node_id FROM f_nodes WHERE kind NOT IN ('work', 'choice', 'collection')
    UNION ALL SELECT 'error', 'node-missing-ref', node_id FROM f_nodes WHERE kind IN ('work', 'collection') AND ref IS NULL UNION ALL SELECT 'error', 'dangling-ref', node_id FROM f_nodes WHERE kind IN ('work', 'collection') AND ref NOT IN (SELECT x FROM m)
    UNION ALL SELECT 'error', 'degenerate-choice', node_id FROM f_nodes WHERE kind = 'choice' AND (option_a IS NULL OR option_b IS NULL) UNION ALL SELECT 'error', 'dangling-choice-option', node_id FROM o WHERE o NOT IN (SELECT node_id FROM f_nodes)
    UNION ALL SELECT 'warning', 'work-not-in-dag', coalesce(alias, work_id) FROM f_works WHERE work_id NOT IN (SELECT ref FROM f_nodes WHERE ref IS NOT NULL) AND coalesce(alias, work_id) NOT IN (SELECT ref FROM f_nodes WHERE ref IS NOT NULL)"""
)
def node_rules(spark: SparkSession, d: str) -> DataFrame:
    return M.node_issues(_nodes(spark), _written(spark, "f_works").select("work_id", _PRESENT("alias").alias("aliases")))


def _nodes(spark: SparkSession) -> DataFrame:
    return _written(spark, "f_nodes").select("node_id", "kind", "ref", _PRESENT("option_a", "option_b").alias("options"))


@query(
    f"""WITH {_values("f_nodes")}, {_values("f_profile")}, c AS (SELECT * FROM f_nodes WHERE kind = 'choice') SELECT 'error' AS severity, 'unknown-choice' AS code, choice_id AS location FROM f_profile WHERE choice_id NOT IN (SELECT node_id FROM c)
    UNION ALL SELECT 'error', 'bad-choice-selection', choice_id FROM f_profile JOIN c ON node_id = choice_id WHERE selected NOT IN (coalesce(option_a, ''), coalesce(option_b, '')) UNION ALL SELECT 'warning', 'choice-not-in-profile', node_id FROM c WHERE node_id NOT IN (SELECT choice_id FROM f_profile)
    UNION ALL SELECT 'warning', 'choice-unselected', choice_id FROM f_profile JOIN c ON node_id = choice_id WHERE selected IS NULL"""
)
def choice_rules(spark: SparkSession, d: str) -> DataFrame:
    return M.choice_issues(_nodes(spark), _written(spark, "f_profile"))


@query(
    f"""WITH {_values("f_pages")}, {_values("f_links")}, {_values("f_anchors")}, h AS (SELECT path, href, path || ' ' || href AS spot, regexp_extract(href, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS scheme, regexp_extract(href, '^([^#?]*)', 1) AS to_, regexp_extract(href, '#(.*)$', 1) AS anchor FROM f_links),
    t AS (SELECT *, CASE WHEN to_ = '' THEN path ELSE regexp_replace(regexp_extract(path, '^(.*/)?[^/]*$', 1) || regexp_replace(to_, '^(?:\\./)+', ''), '[^/]+/\\.\\./', '') END AS target FROM h WHERE scheme = '' AND NOT starts_with(to_, '/'))
    SELECT 'error' AS severity, 'missing-title' AS code, path AS location FROM f_pages WHERE trim(title) = '' UNION ALL SELECT 'error', 'inline-script', path FROM f_pages WHERE inline_scripts > 0
    UNION ALL SELECT 'error', 'bad-link-scheme', spot FROM h WHERE lower(scheme) NOT IN ('', 'http', 'https', 'mailto') UNION ALL SELECT 'error', 'absolute-link', spot FROM h WHERE scheme = '' AND starts_with(to_, '/')
    UNION ALL SELECT 'error', 'broken-link', spot FROM t WHERE target NOT IN (SELECT path FROM f_pages) UNION ALL SELECT 'error', 'broken-anchor', spot FROM t WHERE anchor <> '' AND target IN (SELECT path FROM f_pages) AND target || '#' || anchor NOT IN (SELECT path || '#' || anchor FROM f_anchors)"""
)
def page_rules(spark: SparkSession, d: str) -> DataFrame:
    return M.page_issues(_written(spark, "f_pages"), _written(spark, "f_links"), _written(spark, "f_anchors"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
