"""The query catalogue: every operator over whole tables, beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from refloom.functions import bibliographic as B
from refloom.operators import edges as E
from refloom.operators import extract as X
from refloom.operators import fields as FD
from refloom.operators import graph as G
from refloom.operators import rank as R
from refloom.operators import reading as RD
from refloom.operators import resolve as RS
from refloom.operators import rights as RT
from refloom.operators import terms as T
from refloom.operators import validate as V
from refloom.operators.components import components
from refloom.operators.hierarchy import hierarchy, links, paths
from refloom.plans.materialize import cut
from refloom.sources.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: What strip_accents leaves of Latin-1 that NFKD takes apart (fixed values).
_COMPATIBLE = {"¼": "1/4", "½": "1/2", "¾": "3/4", "¹": "1", "²": "2", "³": "3", "ª": "a", "º": "o"}


def _key(x: str) -> str:
    """The match key in SQL."""
    for a, b in _COMPATIBLE.items():
        x = f"replace({x}, '{a}', '{b}')"
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"


def _surname(x: str) -> str:
    """The surname in SQL: before a comma, else the last word that is no bare initial."""
    words = f"list_filter(string_split_regex(trim({x}), '\\s+'), lambda w: NOT regexp_full_match(w, '\\p{{L}}\\.?'))"
    return f"CASE WHEN contains({x}, ',') THEN trim(split_part({x}, ',', 1)) WHEN len({words}) > 0 THEN {words}[-1] ELSE trim({x}) END"


_WORKS = "works AS (SELECT DISTINCT ON (work_id) work_id, title, year, authors, aliases FROM corpus ORDER BY work_id)"
_DISC = "disc AS (SELECT DISTINCT ON (discovered_id) * FROM discovered ORDER BY discovered_id)"
_DOI = "nullif(lower(regexp_replace(regexp_extract({}, '(?i)\\b(10\\.\\d{{4,9}}/[-._;()/:a-z0-9<>\\[\\]]+)', 1), '[.,;:)\\]>\"'']+$', '')), '')"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "citation_edges", "source", "target")


def _works(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "corpus", "work_id", *cols).where("work_id is not null").dropDuplicates(["work_id"])


@query(
    """SELECT source, target, CAST(count(*) AS BIGINT) AS weight, arg_min(method, (observed_at, coalesce(method, ''), confidence)) AS method,
    round(arg_min(confidence, (observed_at, coalesce(method, ''), confidence)), 4) AS confidence
    FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY ALL"""
)
def citation_edges_collapsed(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "citation_edges", "source", "target", "method", "confidence", "observed_at")
    return E.citations(e.withColumn("m", F.coalesce("method", F.lit(""))), ["observed_at", "m", "confidence"])


_PAIRS = """e AS (SELECT DISTINCT source, target FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL),
n AS (SELECT {i} AS i, count(*) AS n FROM e GROUP BY 1),
p AS (SELECT x.{i} AS a, y.{i} AS b, count(*) AS shared FROM e x JOIN e y ON x.{t} = y.{t} AND x.{i} < y.{i} GROUP BY ALL HAVING count(*) >= 2),
c AS (SELECT a, b, shared, u.n AS size_a, v.n AS size_b, round(shared / sqrt(u.n * v.n), 6) AS cosine FROM p JOIN n u ON u.i = a JOIN n v ON v.i = b)"""
_COUPLING = _PAIRS.format(i="source", t="target")


@query(f"WITH {_COUPLING} SELECT a, b, CAST(shared AS BIGINT) AS shared, CAST(size_a AS BIGINT) AS size_a, CAST(size_b AS BIGINT) AS size_b, cosine FROM c")
def coupling(spark: SparkSession, d: str) -> DataFrame:
    return E.shared_pairs(_edges(spark, d), "source", "target")


@query(f"WITH {_PAIRS.format(i='target', t='source')} SELECT a, b, CAST(shared AS BIGINT) AS shared FROM c")
def cocitation(spark: SparkSession, d: str) -> DataFrame:
    return E.shared_pairs(_edges(spark, d), "target", "source").select("a", "b", "shared")


@query("SELECT target, CAST(count(DISTINCT source) AS BIGINT) AS indegree FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY target")
def citation_indegree(spark: SparkSession, d: str) -> DataFrame:
    return E.indegree(_edges(spark, d))


@query(f"WITH {_COUPLING} SELECT node, round(sum(cosine), 6) AS centrality FROM (SELECT a AS node, cosine FROM c UNION ALL SELECT b, cosine FROM c) GROUP BY node")
def coupling_centrality(spark: SparkSession, d: str) -> DataFrame:
    return E.centrality(coupling(spark, d))


@query(
    f"""WITH RECURSIVE {_COUPLING}, v AS (SELECT a AS x, b AS y FROM c WHERE cosine >= 0.2 UNION SELECT b, a FROM c WHERE cosine >= 0.2),
    nodes AS (SELECT a AS node FROM c UNION SELECT b FROM c),
    r AS (SELECT node, node AS reached FROM nodes UNION SELECT r.node, v.y FROM r JOIN v ON v.x = r.reached)
    SELECT node, min(reached) AS component FROM r GROUP BY node"""
)
def coupling_components(spark: SparkSession, d: str) -> DataFrame:
    """Components of works coupled by a cosine of 0.2 or more; other coupled works are alone."""
    c = cut(coupling(spark, d))
    every = c.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = components(c.where("cosine >= 0.2"), "a", "b")
    return every.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


@query(
    f"""WITH {_WORKS}, g AS (SELECT work_id, nullif(upper(regexp_extract(aliases[1], '^([A-Za-z]+)', 1)), '') AS grp FROM works)
    SELECT e.target, CAST(count(DISTINCT g.grp) AS BIGINT) AS groups FROM citation_edges e JOIN g ON g.work_id = e.source WHERE e.target IS NOT NULL GROUP BY e.target"""
)
def seed_groups(spark: SparkSession, d: str) -> DataFrame:
    """How many independent groups of works cite each target."""
    g = _works(spark, d, "aliases").select(F.col("work_id").alias("source"), B.seed_group(F.get("aliases", F.lit(0))).alias("grp"))
    e = _edges(spark, d).where("source is not null and target is not null").distinct()
    return e.join(g, "source").groupBy("target").agg(F.countDistinct("grp").alias("groups"))


@query(
    f"""WITH {_WORKS} SELECT e.target, string_agg(DISTINCT coalesce(w.aliases[1], w.work_id), ' ' ORDER BY coalesce(w.aliases[1], w.work_id)) AS citing
    FROM citation_edges e JOIN works w ON w.work_id = e.source WHERE e.target IS NOT NULL GROUP BY e.target"""
)
def citing_lists(spark: SparkSession, d: str) -> DataFrame:
    """The sorted aliases of the works that cite each target: as long as its indegree."""
    w = _works(spark, d, "aliases").select(F.col("work_id").alias("source"), F.coalesce(F.get("aliases", F.lit(0)), "work_id").alias("alias"))
    e = _edges(spark, d).where("source is not null and target is not null").distinct()
    return e.join(w, "source").groupBy("target").agg(F.array_join(F.array_sort(F.collect_set("alias")), " ").alias("citing"))


#: After so many rounds the ranks of the SQL no longer change at the places that are compared.
_ROUNDS = 24


def _rank_sql(e: str, t: str = "") -> str:
    """PageRank of the distinct links in the table `e`, as tables with the suffix `t`; the last is pr."""
    steps = "".join(
        f""", r{k}{t} AS MATERIALIZED (SELECT v.node, 0.15 / n.n + 0.85 * s.m / n.n + 0.85 * coalesce(g.g, 0) AS rank FROM v{t} v, n{t} n,
        (SELECT coalesce(sum(rank), 0) AS m FROM r{k - 1}{t} WHERE node NOT IN (SELECT source FROM o{t})) s
        LEFT JOIN (SELECT e.target AS node, sum(r.rank / o.d) AS g FROM {e} e JOIN o{t} o USING (source) JOIN r{k - 1}{t} r ON r.node = e.source GROUP BY 1) g ON g.node = v.node)"""
        for k in range(1, _ROUNDS + 1)
    )
    return f"""o{t} AS (SELECT source, count(*) AS d FROM {e} GROUP BY source), v{t} AS (SELECT source AS node FROM {e} UNION SELECT target FROM {e}), n{t} AS (SELECT count(*) AS n FROM v{t}),
    r0{t} AS (SELECT node, 1.0::DOUBLE / n.n AS rank FROM v{t}, n{t} n){steps}, pr{t} AS (SELECT node, rank / (SELECT sum(rank) FROM r{_ROUNDS}{t}) AS rank FROM r{_ROUNDS}{t})"""


_E = "e AS MATERIALIZED (SELECT DISTINCT source, target FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL)"


@query(f"WITH {_E}, {_rank_sql('e')} SELECT node, round(rank, 8) AS rank FROM pr")
def pagerank(spark: SparkSession, d: str) -> DataFrame:
    """PageRank of the citations, until it changes by less than 1e-10 in all."""
    return G.pagerank(_edges(spark, d), "source", "target").select("node", F.round("rank", 8).alias("rank"))


_ORDER = """e AS (SELECT DISTINCT from_node AS s, to_node AS t FROM dependencies WHERE from_node IS NOT NULL AND to_node IS NOT NULL
  AND lower(trim(edge_type)) IN ('prerequisite', 'conditional', 'orientation', 'historical'))"""


def _order(spark: SparkSession, d: str) -> DataFrame:
    return links(table(spark, d, "dependencies", "from_node", "to_node", "edge_type"), "from_node", "to_node", "edge_type")


@query(f"WITH RECURSIVE {_ORDER}, r AS (SELECT s AS node, t AS reached FROM e UNION SELECT r.node, e.t FROM r JOIN e ON e.s = r.reached) SELECT node, reached FROM r WHERE node <> reached")
def transitive_closure(spark: SparkSession, d: str) -> DataFrame:
    """Everything else that depends on each node, directly or not: a view as long as all paths together. `p4_found`'s intervals say it in one row a node."""
    return G.closure(_order(spark, d), "parent", "child").where("node <> reached")


_LAYERS = f"""RECURSIVE {_ORDER}, up AS (SELECT t AS node, s AS above FROM e UNION SELECT up.node, e.s FROM up JOIN e ON e.t = up.above),
ring AS (SELECT node FROM up WHERE node = above), bad AS (SELECT node FROM ring UNION SELECT up.node FROM up JOIN ring ON ring.node = up.above),
ok AS (SELECT s, t FROM e WHERE t NOT IN (SELECT node FROM bad)),
l AS (SELECT s AS node, 0 AS layer FROM e WHERE s NOT IN (SELECT t FROM e) UNION SELECT ok.t, l.layer + 1 FROM l JOIN ok ON ok.s = l.node),
layers AS (SELECT node, max(layer) AS layer FROM l GROUP BY node)"""


@query(f"WITH {_LAYERS} SELECT node, CAST(layer AS INTEGER) AS layer FROM layers")
def dag_layers(spark: SparkSession, d: str) -> DataFrame:
    """The longest path to each node, over all links."""
    return G.layers(_order(spark, d), "parent", "child")


_BEST = "best AS (SELECT ok.t AS node, arg_min(ok.s, (-layers.layer, ok.s)) AS parent FROM ok JOIN layers ON layers.node = ok.s GROUP BY ok.t)"


def _best(spark: SparkSession, d: str) -> DataFrame:
    pairs = cut(_order(spark, d))
    depth = cut(G.layers(pairs, "parent", "child"))
    return G.best_parents(pairs.join(depth.select(F.col("node").alias("child")), "child", "left_semi"), depth, "parent", "child")


@query(f"WITH {_LAYERS}, {_BEST} SELECT node, parent FROM best")
def best_parents(spark: SparkSession, d: str) -> DataFrame:
    """Of each node's parents the deepest, of several the smallest."""
    return _best(spark, d)


@query(
    f"""WITH {_LAYERS}, {_BEST}, walk AS (SELECT DISTINCT parent AS node, parent AS path FROM best WHERE parent NOT IN (SELECT node FROM best)
    UNION ALL SELECT best.node, walk.path || ' > ' || best.node FROM walk JOIN best ON best.parent = walk.node) SELECT node, path FROM walk"""
)
def canonical_paths(spark: SparkSession, d: str) -> DataFrame:
    """The path to each node over the best parents."""
    tree = cut(hierarchy(_best(spark, d).select("parent", F.col("node").alias("child"))))
    return paths(tree).select(F.col("node_id").alias("node"), F.array_join("path", " > ").alias("path"))


_RING = f"""RECURSIVE {_ORDER}, reach AS (SELECT s AS node, t AS reached FROM e UNION SELECT reach.node, e.t FROM reach JOIN e ON e.s = reach.reached),
ring AS (SELECT e.s AS node, min(e.t) AS next FROM e JOIN reach ON reach.node = e.t AND reach.reached = e.s GROUP BY e.s),
follow AS (SELECT node, next AS at FROM ring UNION SELECT follow.node, ring.next FROM follow JOIN ring ON ring.node = follow.at)"""


@query(f"WITH {_RING} SELECT ring.node, ring.next FROM ring JOIN follow ON follow.node = ring.node AND follow.at = ring.node")
def dependency_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Concrete cycles, link by link: one at least for each group of nodes that reach each other."""
    return G.concrete_cycles(cut(G.on_cycles(_order(spark, d), "parent", "child")))


@query(f"WITH {_ORDER}, x AS (SELECT s AS node, t AS other FROM e) SELECT node, CAST(count(*) AS BIGINT) AS branches FROM x GROUP BY node HAVING count(*) > 1")
def branches(spark: SparkSession, d: str) -> DataFrame:
    """The nodes from which more than one way leads on."""
    return _order(spark, d).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("branches")).where("branches > 1")


#: A graph with a diamond, two cycles that share a node, and what hangs below and above them.
_DIAMOND = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("b", "d"), ("d", "e"), ("x", "e"), ("e", "f"), ("p", "q"), ("q", "r"), ("r", "p"), ("r", "s"), ("s", "r"), ("o", "p"), ("s", "t"), ("t", "u"), ("f", "u"), ("k", "k")]
_DIAMOND_SQL = "e(s, t) AS (VALUES " + ", ".join(f"('{x}', '{y}')" for x, y in _DIAMOND) + ")"


@query(f"WITH {_LAYERS.replace(_ORDER, _DIAMOND_SQL)} SELECT node, CAST(layer AS INTEGER) AS layer FROM layers")
def diamond_layers(spark: SparkSession, d: str) -> DataFrame:
    """`layers` on a written graph in which nodes have several parents."""
    return G.layers(spark.createDataFrame(_DIAMOND, "p string, c string"), "p", "c")


@query(f"WITH {_RING.replace(_ORDER, _DIAMOND_SQL)} SELECT node, next FROM ring")
def diamond_cycles(spark: SparkSession, d: str) -> DataFrame:
    """`on_cycles` on that graph."""
    return G.on_cycles(spark.createDataFrame(_DIAMOND, "p string, c string"), "p", "c")


_ADJ = """e AS (SELECT DISTINCT from_node AS s, to_node AS t, lower(trim(edge_type)) AS k FROM dependencies WHERE from_node IS NOT NULL AND to_node IS NOT NULL),
o AS (SELECT s AS node, string_agg(k || ':' || t, ' ' ORDER BY k || ':' || t) AS outgoing FROM e GROUP BY s),
i AS (SELECT t AS node, string_agg(k || ':' || s, ' ' ORDER BY k || ':' || s) AS incoming FROM e GROUP BY t)"""


@query(f"WITH {_ADJ} SELECT node, coalesce(outgoing, '') AS outgoing, coalesce(incoming, '') AS incoming FROM o FULL JOIN i USING (node)")
def adjacency_text(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dependencies", "from_node", "to_node", "edge_type").withColumn("k", F.lower(F.trim("edge_type")))
    return G.adjacency(e, "from_node", "to_node", "k")


@query(
    f"""WITH t AS (SELECT doc_id AS doc, unnest(regexp_extract_all({_key("text")}, '[a-z][a-z0-9''-]{{2,}}')) AS term FROM documents),
    c AS (SELECT doc, term, count(*) AS c FROM t GROUP BY ALL), m AS (SELECT *, max(c) OVER (PARTITION BY doc) AS most FROM c),
    f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
    s AS (SELECT doc, term, (0.5 + 0.5 * c / most) * ln((1.0 + (SELECT count(DISTINCT doc_id) FROM documents)) / (1 + df)) + 1e-9 AS score FROM m JOIN f USING (term)),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, term) AS place FROM s)
    SELECT doc, CAST(place AS INTEGER) AS place, round(score, 6) AS score FROM r WHERE place <= 12"""
)
def tfidf_top12(spark: SparkSession, d: str) -> DataFrame:
    """The scores of each document's twelve best terms; the terms themselves are in `tfidf_terms`, where ties of rounding can differ."""
    return T.tfidf(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text").select("doc", "place", "score")


@query()
def tfidf_terms(spark: SparkSession, d: str) -> DataFrame:
    return T.tfidf(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


@query(
    f"""WITH {_WORKS}, r AS (SELECT DISTINCT ON (ref_id) * FROM parsed_refs ORDER BY ref_id),
    w AS (SELECT work_id, {_key("title")} AS t, year, list_transform(authors, lambda a: {_key("(" + _surname("a") + ")")}) AS surnames FROM works),
    p AS (SELECT ref_id, {_DOI.format("doi")} AS d, {_key("title")} AS t, year, {_key("(" + _surname("authors[1]") + ")")} AS who FROM r),
    c AS (SELECT ref_id, work_id, CASE WHEN p.year = w.year AND list_contains(w.surnames, p.who) THEN 0.96 WHEN p.year = w.year THEN 0.9 ELSE 0.72 END AS score
          FROM p JOIN w ON p.t = w.t AND length(p.t) > 0),
    b AS (SELECT ref_id, arg_min(work_id, (-score, work_id)) AS work, max(score) AS score FROM c GROUP BY ref_id),
    v AS (SELECT c.ref_id, max(c.score) AS rival FROM c JOIN b USING (ref_id) WHERE c.work_id <> b.work GROUP BY c.ref_id)
    SELECT ref_id, CASE WHEN work IS NULL THEN CASE WHEN d IS NOT NULL OR i.isbn IS NOT NULL OR coalesce(length(t), 0) > 0 THEN 'discovered' ELSE 'unresolved' END
        WHEN (rival IS NOT NULL AND b.score - rival < 0.05) OR b.score < 0.95 THEN 'ambiguous' ELSE 'resolved' END AS status, CAST(b.score AS DOUBLE) AS score
    FROM p LEFT JOIN b USING (ref_id) LEFT JOIN v USING (ref_id) LEFT JOIN (SELECT ref_id, isbn FROM r WHERE regexp_full_match(regexp_replace(isbn, '[\\s-]', '', 'g'), '\\d{{13}}')
      AND list_sum(list_transform(range(1, 14), lambda k: TRY_CAST(substr(regexp_replace(isbn, '[\\s-]', '', 'g'), k, 1) AS INTEGER) * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10 = 0) i USING (ref_id)"""
)
def resolve_references(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "parsed_refs", "ref_id", "doi", "isbn", "title", "year", "authors")
    works = table(spark, d, "corpus", "work_id", "title", "year", "authors", "identifiers")
    return RS.resolve(refs, works).select("ref_id", "status", "score")


@query()
def resolve_targets(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "parsed_refs", "ref_id", "doi", "isbn", "title", "year", "authors")
    works = table(spark, d, "corpus", "work_id", "title", "year", "authors", "identifiers")
    return RS.resolve(refs, works)


_MKEY = f"CASE WHEN length({_key('title')}) > 0 AND year IS NOT NULL AND length({_key('(' + _surname('authors[1]') + ')')}) > 0 THEN {_key('title')} || '|' || year || '|' || {_key('(' + _surname('authors[1]') + ')')} END"


@query(
    f"""WITH {_DISC}, k AS (SELECT discovered_id AS id, doi, isbn, {_MKEY} AS key FROM disc),
    b AS (SELECT key, arg_min(id, (doi IS NULL, isbn IS NULL, id)) AS best FROM k WHERE key IS NOT NULL GROUP BY key)
    SELECT id, coalesce(best, id) AS canonical_id FROM k LEFT JOIN b USING (key)"""
)
def merge_discovered(spark: SparkSession, d: str) -> DataFrame:
    rec = table(spark, d, "discovered", "discovered_id", "title", "authors", "year", "doi", "isbn").withColumnRenamed("discovered_id", "id")
    return E.merge_records(rec)


@query(
    f"""WITH {_DISC} SELECT discovered_id, coalesce('doi:' || {_DOI.format("doi")}, 'local:' || sha256({_key("coalesce(title, '')")})) AS derived_id FROM disc"""
)
def discovered_ids(spark: SparkSession, d: str) -> DataFrame:
    rec = table(spark, d, "discovered", "discovered_id", "title", "doi").where("discovered_id is not null").dropDuplicates(["discovered_id"])
    return rec.select("discovered_id", B.discovered_id(B.doi(F.col("doi")), F.lit(None).cast("string"), F.coalesce("title", F.lit(""))).alias("derived_id"))


@query(f"WITH {_DISC} SELECT discovered_id, {_DOI.format('doi')} AS doi FROM disc WHERE doi IS NOT NULL")
def doi_normalised(spark: SparkSession, d: str) -> DataFrame:
    rec = table(spark, d, "discovered", "discovered_id", "doi").where("discovered_id is not null").dropDuplicates(["discovered_id"])
    return rec.where("doi is not null").select("discovered_id", B.doi(F.col("doi")).alias("doi"))


_CLEAN_ISBN = "upper(regexp_replace(isbn, '[\\s-]', '', 'g'))"


@query(
    f"""WITH {_DISC}, r AS (SELECT discovered_id, {_CLEAN_ISBN} AS s FROM disc WHERE isbn IS NOT NULL)
    SELECT discovered_id, CASE WHEN regexp_full_match(s, '\\d{{13}}') AND list_sum(list_transform(range(1, 14), lambda k: TRY_CAST(substr(s, k, 1) AS INTEGER) * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10 = 0 THEN s END AS isbn13 FROM r"""
)
def isbn_checksum(spark: SparkSession, d: str) -> DataFrame:
    rec = table(spark, d, "discovered", "discovered_id", "isbn").where("discovered_id is not null").dropDuplicates(["discovered_id"])
    return rec.where("isbn is not null").select("discovered_id", B.isbn13(F.col("isbn")).alias("isbn13"))


@query(
    f"""WITH {_WORKS}, a AS (SELECT work_id, unnest(authors) AS name FROM works) SELECT work_id, name, {_key("(" + _surname("name") + ")")} AS surname FROM a WHERE name IS NOT NULL"""
)
def author_surnames(spark: SparkSession, d: str) -> DataFrame:
    rows = _works(spark, d, "authors").select("work_id", F.explode("authors").alias("name")).where("name is not null")
    return rows.select("work_id", "name", B.match_key(B.surname(F.col("name"))).alias("surname"))


@query()
def authorship_edges(spark: SparkSession, d: str) -> DataFrame:
    """Author to work, for works of the corpus and discovered ones."""
    a = E.authorship(table(spark, d, "corpus", "work_id", "authors"), "work_id", "authors", 0.5, "normalized-name")
    b = E.authorship(table(spark, d, "discovered", "discovered_id", "authors"), "discovered_id", "authors", 0.35, "normalized-name-from-reference")
    return a.unionByName(b)


_CREDIT = f"""{_WORKS}, a AS (SELECT work_id, lower(name) AS author, team FROM (SELECT work_id, len(list_filter(authors, lambda x: x IS NOT NULL)) AS team, unnest(authors) AS name FROM works) WHERE name IS NOT NULL),
i AS (SELECT target, count(DISTINCT source) AS indegree FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY target),
n AS (SELECT x.author, count(DISTINCT y.author) AS coauthors FROM a x JOIN a y ON x.work_id = y.work_id AND x.author <> y.author GROUP BY x.author)"""


@query(
    f"""WITH {_CREDIT} SELECT a.author, CAST(count(DISTINCT a.work_id) AS BIGINT) AS works, round(sum(coalesce(indegree, 0) / team), 4) AS credit, CAST(coalesce(any_value(coauthors), 0) AS BIGINT) AS coauthors
    FROM a LEFT JOIN i ON i.target = a.work_id LEFT JOIN n ON n.author = a.author GROUP BY a.author"""
)
def author_credit(spark: SparkSession, d: str) -> DataFrame:
    """Shared citation credit by name as written, without case."""
    a = E.authorship(table(spark, d, "corpus", "work_id", "authors"), "work_id", "authors", 0.5, "normalized-name").withColumn("author", F.lower("name"))
    return R.author_credit(a, E.indegree(_edges(spark, d)))


@query(
    """WITH a AS (SELECT DISTINCT author_id, split_part(regexp_replace(author_id, '^author:', ''), ' ', 1) AS k FROM author_rankings WHERE author_id IS NOT NULL)
    SELECT x.author_id, string_agg(y.author_id, ' ' ORDER BY y.author_id) AS collisions FROM a x JOIN a y ON x.k = y.k AND x.author_id <> y.author_id GROUP BY x.author_id"""
)
def name_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Other authors whose key begins with the same surname: the surname's sorted list without the author's own."""
    a = table(spark, d, "author_rankings", "author_id").where("author_id is not null").distinct().withColumn("k", B.surname_key(F.col("author_id")))
    lists = a.groupBy("k").agg(F.array_sort(F.collect_list("author_id")).alias("ids")).where(F.size("ids") > 1)
    return a.join(lists, "k").select("author_id", F.array_join(F.array_remove("ids", F.col("author_id")), " ").alias("collisions"))


def _dims_sql(e: str, t: str = "") -> str:
    """Every node's four dimensions, raw and on 0 to 1 (nd), from the links in `e`, as tables with the suffix `t`."""
    lo_hi = ", ".join(f"(d.{k} - min(d.{k}) OVER ()) / nullif(max(d.{k}) OVER () - min(d.{k}) OVER (), 0) AS n_{k}" for k in R.WEIGHTS)
    pairs = f"""nc{t} AS (SELECT source AS i, count(*) AS n FROM {e} GROUP BY 1),
pc{t} AS (SELECT x.source AS a, y.source AS b, count(*) AS shared FROM {e} x JOIN {e} y ON x.target = y.target AND x.source < y.source GROUP BY ALL HAVING count(*) >= 2),
cc{t} AS (SELECT a, b, round(shared / sqrt(u.n * v.n), 6) AS cosine FROM pc{t} JOIN nc{t} u ON u.i = a JOIN nc{t} v ON v.i = b)"""
    return f"""{pairs}, {_rank_sql(e, t)},
ce{t} AS (SELECT node, round(sum(cosine), 6) AS centrality FROM (SELECT a AS node, cosine FROM cc{t} UNION ALL SELECT b, cosine FROM cc{t}) GROUP BY node),
de{t} AS (SELECT target AS node, count(*) AS indegree FROM {e} GROUP BY target),
gr{t} AS (SELECT e.target AS node, count(DISTINCT nullif(upper(regexp_extract(w.aliases[1], '^([A-Za-z]+)', 1)), '')) AS groups FROM {e} e JOIN works w ON w.work_id = e.source GROUP BY e.target),
dims{t} AS (SELECT node, coalesce(indegree, 0) AS indegree, pr.rank, coalesce(centrality, 0) AS centrality, coalesce(groups, 0) AS groups FROM pr{t} pr LEFT JOIN de{t} USING (node) LEFT JOIN ce{t} USING (node) LEFT JOIN gr{t} USING (node)),
nd{t} AS MATERIALIZED (SELECT d.*, {lo_hi} FROM dims{t} d)"""


_DIMS = f"{_E}, {_WORKS}, {_dims_sql('e')}"
_BY = "score DESC, indegree DESC, node"


def _score_sql(w: dict[str, float]) -> str:
    return "round(" + " + ".join(f"{v}::DOUBLE * coalesce(n_{k}, 0)" for k, v in w.items()) + ", 6)"


def _dims(spark: SparkSession, d: str, without: str | None = None) -> DataFrame:
    """Every work's four dimensions; `without` leaves a work and its citations out of all of them."""
    e = _edges(spark, d).where("source is not null and target is not null").distinct()
    if without is not None:
        e = e.where((F.col("source") != without) & (F.col("target") != without))
    e = cut(e)
    g = _works(spark, d, "aliases").select(F.col("work_id").alias("source"), B.seed_group(F.get("aliases", F.lit(0))).alias("grp"))
    groups = e.join(g, "source").groupBy(F.col("target").alias("node")).agg(F.countDistinct("grp").alias("groups"))
    ranks = G.pagerank(e, "source", "target")
    out = ranks.join(E.indegree(e).withColumnRenamed("target", "node"), "node", "left").join(E.centrality(E.shared_pairs(e, "source", "target")), "node", "left").join(groups, "node", "left")
    return cut(out.na.fill(0))


@query(f"WITH {_DIMS} SELECT node, CAST(indegree AS BIGINT) AS indegree, round(rank, 8) AS rank, centrality, CAST(groups AS BIGINT) AS groups, {_score_sql(R.WEIGHTS)} AS score FROM nd")
def work_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Every work's dimensions and its weighted score."""
    return R.scored(_dims(spark, d)).select("node", "indegree", F.round("rank", 8).alias("rank"), "centrality", "groups", "score")


_SCORED = f"s AS (SELECT node, indegree, {_score_sql(R.WEIGHTS)} AS score FROM nd)"


@query(f"WITH {_DIMS}, {_SCORED} SELECT node, CAST(indegree AS BIGINT) AS indegree, score, CAST(row_number() OVER (ORDER BY {_BY}) AS INTEGER) AS place FROM s ORDER BY {_BY} LIMIT 10")
def work_ranking_top10(spark: SparkSession, d: str) -> DataFrame:
    return R.top(R.scored(_dims(spark, d)).select("node", "indegree", "score"), 10)


_VARIANTS = " UNION ALL ".join(
    f"SELECT '{k}' AS dim, {dl}::DOUBLE AS delta, node, indegree, {_score_sql({j: max(0.0, w + (dl if j == k else 0.0)) for j, w in R.WEIGHTS.items()})} AS score FROM nd" for k in R.WEIGHTS for dl in R.DELTAS
)


@query(
    f"""WITH {_DIMS}, {_SCORED}, va AS ({_VARIANTS}), ra AS (SELECT *, row_number() OVER (PARTITION BY dim, delta ORDER BY {_BY}) AS place FROM va),
    l AS (SELECT dim, delta, list(node ORDER BY place) AS l FROM ra WHERE place <= 10 GROUP BY ALL),
    b AS (SELECT list(node ORDER BY {_BY}) AS b FROM (SELECT * FROM s ORDER BY {_BY} LIMIT 10))
    SELECT dim, delta, array_to_string(list_sort(list_filter(l, lambda x: NOT list_contains(b, x))), ',') AS entered, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(l, x))), ',') AS "left", l <> b AS changed FROM l, b"""
)
def sensitivity_grid(spark: SparkSession, d: str) -> DataFrame:
    """How the ten best change when one weight moves: sixteen variants."""
    return R.sensitivity(_dims(spark, d))


@query(
    f"""WITH {_DIMS}, {_SCORED}, b AS MATERIALIZED (SELECT node, row_number() OVER (ORDER BY {_BY}) AS place FROM s ORDER BY {_BY} LIMIT 11),
    e2 AS MATERIALIZED (SELECT * FROM e WHERE source <> (SELECT node FROM b WHERE place = 1) AND target <> (SELECT node FROM b WHERE place = 1)), {_dims_sql('e2', 'x')},
    s2 AS (SELECT node, indegree, {_score_sql(R.WEIGHTS)} AS score FROM ndx)
    SELECT a.node, CAST(a.place AS INTEGER) AS place, CAST(b.place AS INTEGER) AS was FROM (SELECT node, row_number() OVER (ORDER BY {_BY}) AS place FROM s2 ORDER BY {_BY} LIMIT 10) a LEFT JOIN b USING (node)"""
)
def leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    """The ten best without the best work, PageRank and all other dimensions computed anew, beside the places they had."""
    before = cut(R.top(R.scored(_dims(spark, d)).select("node", "indegree", "score"), 11))
    best = before.where("place = 1").first()
    if best is None:
        return before.select("node", "place", F.lit(None).cast("int").alias("was"))
    after = R.top(R.scored(_dims(spark, d, best["node"])).select("node", "indegree", "score"), 10)
    return after.join(before.select("node", F.col("place").alias("was")), "node", "left").select("node", "place", "was")


@query(
    f"""WITH {_DISC} SELECT discovered_id, CAST(len(cited_by) AS INTEGER) AS citing_count FROM disc WHERE len(cited_by) >= 2 AND year BETWEEN 1990 AND 2024 ORDER BY len(cited_by) DESC, discovered_id LIMIT 20"""
)
def promotion_queue(spark: SparkSession, d: str) -> DataFrame:
    """The discovered works that are cited most, within a range of years."""
    rec = table(spark, d, "discovered", "discovered_id", "cited_by", "year").where("discovered_id is not null").dropDuplicates(["discovered_id"])
    few = rec.where((F.size("cited_by") >= 2) & F.col("year").between(1990, 2024)).select("discovered_id", F.size("cited_by").alias("citing_count"))
    return few.orderBy(F.desc("citing_count"), "discovered_id").limit(20)


@query(
    f"""WITH w AS (SELECT DISTINCT ON (work_id) work_id, work_type, metadata_status FROM corpus ORDER BY work_id)
    SELECT work_type, CAST(count(*) AS BIGINT) AS works, CAST(count(*) FILTER (metadata_status = 'verified') AS BIGINT) AS verified, CAST(count(*) FILTER (metadata_status = 'unverified') AS BIGINT) AS unverified FROM w GROUP BY work_type"""
)
def status_matrix(spark: SparkSession, d: str) -> DataFrame:
    w = _works(spark, d, "work_type", "metadata_status")
    tally = lambda s: F.count(F.when(F.col("metadata_status") == s, 1)).alias(s)
    return w.groupBy("work_type").agg(F.count("*").alias("works"), tally("verified"), tally("unverified"))


@query(
    f"""WITH {_WORKS}, g AS (SELECT nullif(upper(regexp_extract(aliases[1], '^([A-Za-z]+)', 1)), '') AS grp, year FROM works)
    SELECT coalesce(grp, '-') AS grp, CAST(min(year) AS INTEGER) AS earliest, CAST(max(year) AS INTEGER) AS latest, CAST(count(*) FILTER (year IS NULL) AS BIGINT) AS without_year FROM g GROUP BY 1"""
)
def coverage(spark: SparkSession, d: str) -> DataFrame:
    """The years each group of works covers."""
    g = _works(spark, d, "aliases", "year").select(F.coalesce(B.seed_group(F.get("aliases", F.lit(0))), F.lit("-")).alias("grp"), "year")
    return g.groupBy("grp").agg(F.min("year").alias("earliest"), F.max("year").alias("latest"), F.count(F.when(F.col("year").isNull(), 1)).alias("without_year"))


@query(
    """SELECT DISTINCT target FROM citation_edges WHERE target IS NOT NULL AND target NOT IN (SELECT work_id FROM corpus WHERE work_id IS NOT NULL)
    AND target NOT IN (SELECT discovered_id FROM discovered WHERE discovered_id IS NOT NULL) AND target NOT IN (SELECT work_id FROM seeds)"""
)
def dangling_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets that no table knows as written."""
    known = table(spark, d, "corpus", "work_id").unionByName(table(spark, d, "discovered", "discovered_id").toDF("work_id")).unionByName(table(spark, d, "seeds", "work_id")).distinct()
    t = table(spark, d, "citation_edges", "target").where("target is not null").distinct()
    return t.join(known, t["target"] == known["work_id"], "left_anti")


@query("SELECT DISTINCT c.work_id FROM corpus c WHERE work_id IS NOT NULL AND work_id NOT IN (SELECT work_id FROM documents WHERE section = 'fulltext' AND work_id IS NOT NULL)")
def works_without_fulltext(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "documents", "work_id", "section").where("section = 'fulltext'").select("work_id")
    return table(spark, d, "corpus", "work_id").where("work_id is not null").distinct().join(have, "work_id", "left_anti")


_ISSUES = """w AS (SELECT * FROM corpus),
al AS (SELECT DISTINCT work_id, unnest(aliases) AS alias FROM corpus),
d AS (SELECT from_node AS f, to_node AS t, lower(trim(edge_type)) AS k FROM dependencies),
od AS (SELECT DISTINCT t AS c, f AS p FROM d WHERE f IS NOT NULL AND t IS NOT NULL AND k IN ('prerequisite', 'conditional', 'orientation', 'historical')),
up AS (SELECT c AS node, p AS above FROM od UNION SELECT up.node, od.p FROM up JOIN od ON od.c = up.above),
i AS (
  SELECT 'error' AS severity, 'duplicate-alias' AS code, alias AS location FROM al WHERE alias IS NOT NULL GROUP BY alias HAVING count(*) > 1
  UNION SELECT 'error', 'duplicate-work-id', work_id FROM (SELECT DISTINCT work_id, title, work_type FROM w) WHERE work_id IS NOT NULL GROUP BY work_id HAVING count(*) > 1
  UNION SELECT 'error', 'missing-alias', work_id FROM w WHERE coalesce(len(aliases), 0) = 0
  UNION SELECT 'error', 'bad-work-type', work_id FROM w WHERE work_type NOT IN ('article', 'book', 'notes', 'sequence', 'web_page', 'collection')
  UNION SELECT 'error', 'bad-metadata-status', work_id FROM w WHERE metadata_status NOT IN ('verified', 'unverified')
  UNION SELECT 'error', 'bad-title-status', work_id FROM w WHERE title_status NOT IN ('present', 'unknown')
  UNION SELECT 'error', 'empty-title', work_id FROM w WHERE title_status = 'present' AND trim(coalesce(title, '')) = ''
  UNION SELECT 'error', 'unverifiable-metadata', work_id FROM w WHERE metadata_status = 'verified' AND title_status <> 'present'
  UNION SELECT 'warning', 'unverified-work', work_id FROM w WHERE metadata_status = 'unverified'
  UNION SELECT 'error', 'bad-access', work_id FROM w WHERE access_state NOT IN ('open', 'preview', 'borrow', 'purchase', 'institutional', 'unknown')
  UNION SELECT 'error', 'empty-identifier', work_id FROM w WHERE len(list_filter(map_values(identifiers), lambda v: v IS NULL OR v = '')) > 0
  UNION SELECT 'error', 'bad-edge-type', concat_ws('>', f, t, k) FROM d WHERE k NOT IN ('prerequisite', 'backup', 'validates', 'conditional', 'orientation', 'historical')
  UNION SELECT 'error', 'dangling-edge-endpoint', concat_ws('>', f, t, k) FROM d WHERE f IS NULL OR t IS NULL
  UNION SELECT 'error', 'self-edge', concat_ws('>', f, t, k) FROM d WHERE f = t
  UNION SELECT 'error', 'duplicate-edge', concat_ws('>', f, t, k) FROM d WHERE f IS NOT NULL AND t IS NOT NULL GROUP BY f, t, k HAVING count(*) > 1
  UNION SELECT 'error', 'dependency-cycle', node FROM up WHERE node = above)"""


@query(f"WITH RECURSIVE {_ISSUES} SELECT severity, code, location FROM i")
def validator_issues(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "corpus", "work_id", "aliases", "title", "title_status", "work_type", "metadata_status", "access_state", "identifiers")
    deps = table(spark, d, "dependencies", "from_node", "to_node", "edge_type")
    return V.corpus_issues(works).unionByName(V.dependency_issues(deps, G.on_cycles(_order(spark, d), "parent", "child")))


@query("SELECT severity, code, CAST(count(*) AS BIGINT) AS issues FROM (WITH RECURSIVE " + _ISSUES + " SELECT * FROM i) GROUP BY ALL")
def validator_summary(spark: SparkSession, d: str) -> DataFrame:
    return validator_issues(spark, d).groupBy("severity", "code").agg(F.count("*").alias("issues"))


@query("SELECT work_id, max(loaded_at) AS loaded_at, CAST(count(*) AS BIGINT) AS deliveries FROM corpus WHERE work_id IS NOT NULL GROUP BY work_id")
def latest_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of each work: the upsert view of an append-only table."""
    c = table(spark, d, "corpus", "work_id", "loaded_at").where("work_id is not null")
    return E.latest(c, "work_id", "loaded_at").join(c.groupBy("work_id").agg(F.count("*").alias("deliveries")), "work_id")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def latest_event_by_user(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events", "user_id", "event_type", "value", "ts", "event_id")
    return E.latest(ev, "user_id", "ts", "event_id").select("user_id", "event_type", "value")


@query("SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS attempts FROM events GROUP BY ALL")
def attempt_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count("*").alias("attempts"))


@query(
    """WITH h AS (SELECT page_id, block_no, text FROM page_blocks WHERE kind = 'heading')
    SELECT page_id, block_no, lag(text) OVER w AS previous, lead(text) OVER w AS following FROM h WINDOW w AS (PARTITION BY page_id ORDER BY block_no)"""
)
def heading_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The headings before and after each heading of a page."""
    h = table(spark, d, "page_blocks", "page_id", "block_no", "kind", "text").where("kind = 'heading'")
    w = W.partitionBy("page_id").orderBy("block_no")
    return h.select("page_id", "block_no", F.lag("text").over(w).alias("previous"), F.lead("text").over(w).alias("following"))


@query(
    """WITH h AS (SELECT b.page_id, b.block_no, b.end_char, length(p.text) AS n, b.start_char FROM page_blocks b JOIN parsed_html p USING (page_id) WHERE b.kind = 'heading')
    SELECT page_id, block_no, CAST(end_char AS INTEGER) AS body_start, CAST(coalesce(lead(start_char) OVER (PARTITION BY page_id ORDER BY start_char), n) AS INTEGER) AS body_end FROM h"""
)
def section_bodies(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "page_blocks", "page_id", "block_no", "kind", "start_char", "end_char").where("kind = 'heading'")
    n = table(spark, d, "parsed_html", "page_id", "text").select("page_id", F.length("text").alias("n"))
    return X.section_bodies(h.join(n, "page_id"), "page_id", "start_char", "end_char", "n").select("page_id", "block_no", "body_start", "body_end")


_LINES = """l AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc, ls, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM l),
y AS (SELECT doc, CAST(k - 1 AS INTEGER) AS line_no, line, CAST(coalesce(list_sum(list_transform(ls[1:k - 1], lambda s: length(s) + 1)), 0) AS INTEGER) AS start,
  trim(coalesce(CASE WHEN k > 1 THEN ls[k - 1] END, ''), ' ') = '' AS blank_before, trim(coalesce(ls[k + 1], ''), ' ') = '' AS blank_after FROM x)"""


@query(f"WITH {_LINES} SELECT doc, line_no, start, CAST(length(line) AS INTEGER) AS length, blank_before, blank_after FROM y")
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    return X.lines(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text").select("doc", "line_no", "start", F.length("line").alias("length"), "blank_before", "blank_after")


@query()
def text_headings(spark: SparkSession, d: str) -> DataFrame:
    """Lines of texts that read as headings, with their role."""
    ls = X.lines(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    h = ls.withColumn("kind", X.heading_kind(F.col("line"), F.col("blank_before"), F.col("blank_after"))).where("kind is not null")
    return h.select("doc", "line_no", "line", "kind", X.role(F.col("line")).alias("role"))


@query(
    """SELECT doc_id AS doc, CAST(len(regexp_extract_all(text, '(?m)^[ ]*(?:\\[\\d+\\]|\\(?\\d{1,3}[.)])[ ]+')) AS BIGINT) AS markers FROM documents WHERE section = 'references'
    AND len(regexp_extract_all(text, '(?m)^[ ]*(?:\\[\\d+\\]|\\(?\\d{1,3}[.)])[ ]+')) > 0"""
)
def reference_markers(spark: SparkSession, d: str) -> DataFrame:
    """How many entries of each numbered reference section begin at a marker."""
    docs = table(spark, d, "documents", "doc_id", "text", "section").where("section = 'references'").dropDuplicates(["doc_id"])
    seg = X.segment_references(docs, "doc_id", "text").where(F.col("raw").rlike(r"^(?:\[\d+\]|\(?\d{1,3}[.)])\s+"))
    return seg.groupBy("doc").agg(F.count("*").alias("markers"))


@query()
def reference_entries(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "section").where("section = 'references'").dropDuplicates(["doc_id"])
    return X.segment_references(docs, "doc_id", "text")


_BARE = "regexp_replace(regexp_replace(raw, '^\\s*(?:\\[\\d+\\]|\\(?\\d+[.)])\\s*', ''), '(?i)https?://\\S+|(?:doi:?\\s*)?\\b10\\.\\d{4,9}/\\S+|isbn[:\\s]*[\\dxX -]{10,17}', ' ', 'g')"


@query(
    f"""WITH r AS (SELECT DISTINCT ON (ref_id) ref_id, raw FROM parsed_refs WHERE raw IS NOT NULL ORDER BY ref_id), c AS (SELECT ref_id, raw, {_BARE} AS s FROM r)
    SELECT ref_id, {_DOI.format("raw")} AS doi, TRY_CAST(regexp_extract_all(s, '\\b(1[5-9]\\d\\d|20\\d\\d)\\b', 1)[-1] AS INTEGER) AS year,
    nullif(regexp_extract(s, '(\\d+)\\s*\\((\\d+)\\)\\s*[:,]?\\s*(\\d+)\\s*[-–]\\s*(\\d+)', 1), '') AS volume FROM c"""
)
def parsed_references(spark: SparkSession, d: str) -> DataFrame:
    """DOI, year and volume read from reference strings; `parsed_reference_titles` has the rest."""
    r = table(spark, d, "parsed_refs", "ref_id", "raw").where("ref_id is not null and raw is not null").dropDuplicates(["ref_id"])
    return r.select("ref_id", B.parsed_reference(F.col("raw")).alias("p")).select("ref_id", "p.doi", "p.year", "p.volume")


@query()
def parsed_reference_titles(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "parsed_refs", "ref_id", "raw").where("ref_id is not null and raw is not null").dropDuplicates(["ref_id"])
    return r.select("ref_id", B.parsed_reference(F.col("raw")).alias("p")).select("ref_id", "p.*")


@query("SELECT page_id, meta['citation_title'][1] AS title, CAST(coalesce(len(meta['citation_author']), 0) AS INTEGER) AS authors FROM parsed_html")
def citation_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "parsed_html", "page_id", "meta").select("page_id", B.citation_metadata(F.col("meta")).alias("m"))
    return m.select("page_id", "m.title", F.size("m.authors").alias("authors"))


@query("SELECT page_id, lower(regexp_extract(url, '://([^/]+)', 1)) AS host, regexp_extract(url, '://[^/]+(/[^?#]*)', 1) AS path FROM parsed_html WHERE url IS NOT NULL")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed_html", "page_id", "url").where("url is not null")
    return p.select("page_id", B.host(F.col("url")).alias("host"), B.url_path(F.col("url")).alias("path"))


_MATRIX = ", ".join(f"('{t}', '{f}', '{v}')" for t, kinds in X.EXPECTED.items() for f, v in kinds.items())


@query(
    f"""WITH m(work_type, section, expectation) AS (VALUES {_MATRIX}), s AS (SELECT DISTINCT work_id, work_type, section FROM documents WHERE work_id IS NOT NULL),
    w AS (SELECT DISTINCT work_id, work_type FROM s)
    SELECT w.work_id, w.work_type, m.section, m.expectation, CASE WHEN s.section IS NOT NULL THEN 'present' WHEN m.expectation = 'not_applicable' THEN 'not_applicable' ELSE 'not_present' END AS state
    FROM w JOIN m ON m.work_type = w.work_type LEFT JOIN s ON s.work_id = w.work_id AND s.work_type = w.work_type AND s.section = m.section"""
)
def expectation_matrix(spark: SparkSession, d: str) -> DataFrame:
    """For each work which fields are there and which were expected."""
    s = cut(table(spark, d, "documents", "work_id", "work_type", "section").where("work_id is not null").distinct())
    w = s.select("work_id", "work_type").distinct().where(F.col("work_type").isin(*X.EXPECTED))
    fields = w.select("work_id", "work_type", F.explode(F.array(*map(F.lit, X.ROLES))).alias("section"))
    have = s.withColumn("have", F.lit(True))
    out = fields.join(have, ["work_id", "work_type", "section"], "left").withColumn("expectation", X.expectation(F.col("work_type"), F.col("section")))
    state = F.when(F.col("have"), "present").when(F.col("expectation") == "not_applicable", "not_applicable").otherwise("not_present")
    return out.select("work_id", "work_type", "section", "expectation", state.alias("state"))


@query(
    f"""WITH w AS (SELECT DISTINCT ON (work_id) work_id, access_state, license FROM corpus WHERE work_id IS NOT NULL ORDER BY work_id),
    d AS (SELECT doc_id, section, text, w.access_state = 'open' AS open, w.license FROM documents d JOIN w USING (work_id))
    SELECT doc_id, CASE WHEN section = 'references' THEN true WHEN section IN ('abstract', 'introduction', 'conclusion') THEN coalesce(open, false) AND license IS NOT NULL ELSE false END AS allowed,
    CASE WHEN section = 'references' THEN 'metadata' WHEN section NOT IN ('abstract', 'introduction', 'conclusion') THEN 'unknown field' WHEN NOT coalesce(open, false) THEN 'text withheld' WHEN license IS NULL THEN 'no licence evidence' ELSE 'licensed' END AS reason FROM d"""
)
def clearance_mask(spark: SparkSession, d: str) -> DataFrame:
    """Which texts may be published; works are open or not, their licence is the evidence."""
    w = E.latest(table(spark, d, "corpus", "work_id", "access_state", "license").where("work_id is not null"), "work_id", "access_state")
    docs = table(spark, d, "documents", "doc_id", "work_id", "section").join(w, "work_id")
    open_ = F.col("access_state") == "open"
    c = RT.clearance(F.col("section"), F.lit(True), open_, open_, F.col("license"))
    return docs.select("doc_id", c.alias("c")).select("doc_id", "c.allowed", "c.reason")


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b') THEN 'email' WHEN regexp_matches(text, '(?i)\\b(api[_-]?key|secret|token|password)\\b\\s*[=:]\\s*\\S+') THEN 'key-value'
    WHEN regexp_matches(text, '\\bsk-[A-Za-z0-9]{16,}\\b') THEN 'token' WHEN regexp_matches(text, '(?:/home/|/Users/)[A-Za-z0-9._-]+/') THEN 'path' ELSE 'none' END AS leak FROM documents WHERE text IS NOT NULL"""
)
def leak_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.coalesce(RT.leak(F.col("text")), F.lit("none")).alias("leak"))


@query(
    f"""WITH e AS (SELECT DISTINCT source, target FROM citation_edges WHERE source IS NOT NULL AND target IS NOT NULL),
    p AS (SELECT DISTINCT from_node, to_node, lower(trim(edge_type)) AS kind FROM dependencies WHERE from_node IS NOT NULL AND to_node IS NOT NULL)
    SELECT 'citation' AS kind, source, target, NULL AS detail FROM e UNION ALL SELECT 'dependency', from_node, to_node, kind FROM p"""
)
def edge_union(spark: SparkSession, d: str) -> DataFrame:
    """Edges of different kinds in one table, with columns that only some have."""
    c = _edges(spark, d).where("source is not null and target is not null").distinct().withColumn("kind", F.lit("citation"))
    p = table(spark, d, "dependencies", F.col("from_node").alias("source"), F.col("to_node").alias("target"), F.lower(F.trim("edge_type")).alias("detail"))
    p = p.where("source is not null and target is not null").distinct().withColumn("kind", F.lit("dependency"))
    return c.unionByName(p, allowMissingColumns=True).select("kind", "source", "target", "detail")


@query(
    f"""WITH {_WORKS}, r AS (SELECT DISTINCT ON (ref_id) ref_id, title, year FROM parsed_refs WHERE title IS NOT NULL ORDER BY ref_id),
    x AS (SELECT ref_id, year, list_distinct(string_split({_key("title")}, ' ')) AS t, array_to_string(string_split({_key("title")}, ' ')[1:4], ' ') AS k FROM r),
    y AS (SELECT work_id, year, list_distinct(string_split({_key("title")}, ' ')) AS t, array_to_string(string_split({_key("title")}, ' ')[1:4], ' ') AS k FROM works WHERE title IS NOT NULL),
    s AS (SELECT ref_id, work_id, greatest(0, least(0.99, 0.8 * len(list_intersect(x.t, y.t)) / len(list_distinct(list_concat(x.t, y.t))) + CASE WHEN x.year = y.year THEN 0.12 WHEN abs(x.year - y.year) > 1 THEN -0.25 ELSE 0 END)) AS score FROM x JOIN y USING (k))
    SELECT ref_id, work_id, round(score, 6) AS score FROM s WHERE score >= 0.6"""
)
def match_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of references and works whose titles begin with the same four words."""
    r = table(spark, d, "parsed_refs", "ref_id", "title", "year").where("ref_id is not null and title is not null").dropDuplicates(["ref_id"])
    w = _works(spark, d, "title", "year").where("title is not null")
    start = F.array_join(F.slice(F.split(B.match_key(F.col("title")), " "), 1, 4), " ")
    x = r.select("ref_id", F.col("title").alias("tx"), F.col("year").alias("yx"), start.alias("k"))
    y = w.select("work_id", F.col("title").alias("ty"), F.col("year").alias("yy"), start.alias("k"))
    s = x.join(y, "k").withColumn("score", B.match_score(F.col("tx"), F.col("ty"), F.col("yx"), F.col("yy"), F.lit(False)))
    return s.where("score >= 0.6").select("ref_id", "work_id", F.round("score", 6).alias("score"))


@query("SELECT ref_id, array_to_string(list_sort(warnings), ';') AS warnings FROM (SELECT DISTINCT ON (ref_id) ref_id, warnings FROM parsed_refs ORDER BY ref_id) WHERE len(warnings) > 0")
def reference_warnings(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "parsed_refs", "ref_id", "warnings").where("ref_id is not null").dropDuplicates(["ref_id"])
    return r.where(F.size("warnings") > 0).select("ref_id", F.array_join(F.array_sort("warnings"), ";").alias("warnings"))


@query(
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, CAST(count(*) AS BIGINT) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL"""
)
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows; `refloom.streaming` has the same over a stream with a watermark."""
    ev = table(spark, d, "events", "ts", "event_type", "value")
    w = ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("w.start").alias("hour"), "event_type", "events", "total")


@query(
    """WITH w AS (SELECT DISTINCT work_id, work_type, access_state, title_status FROM corpus), d AS (SELECT DISTINCT from_node, to_node, lower(trim(edge_type)) AS k FROM dependencies WHERE from_node IS NOT NULL AND to_node IS NOT NULL)
    SELECT 'works' AS what, 'all' AS kind, CAST(count(DISTINCT work_id) AS BIGINT) AS n FROM w UNION ALL SELECT 'access', coalesce(access_state, '-'), CAST(count(DISTINCT work_id) AS BIGINT) FROM w GROUP BY 2
    UNION ALL SELECT 'edges', coalesce(k, '-'), CAST(count(*) AS BIGINT) FROM d GROUP BY 2"""
)
def corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts of works, access states and kinds of links."""
    w = table(spark, d, "corpus", "work_id", "access_state").distinct()
    e = table(spark, d, "dependencies", "from_node", "to_node", F.lower(F.trim("edge_type")).alias("k")).where("from_node is not null and to_node is not null").distinct()
    n = lambda df, what, kind, count: df.groupBy(F.coalesce(kind, F.lit("-")).alias("kind")).agg(count.alias("n")).select(F.lit(what).alias("what"), "kind", "n")
    works = F.countDistinct("work_id")
    return n(w, "works", F.lit("all"), works).unionByName(n(w, "access", F.col("access_state"), works)).unionByName(n(e, "edges", F.col("k"), F.count("*")))


@query()
def resolution_summary(spark: SparkSession, d: str) -> DataFrame:
    return RS.summary(resolve_targets(spark, d))


@query(
    f"""WITH RECURSIVE {_COUPLING}, {_WORKS}, v AS (SELECT a AS x, b AS y FROM c WHERE cosine >= 0.2 UNION SELECT b, a FROM c WHERE cosine >= 0.2),
    nodes AS (SELECT a AS node FROM c UNION SELECT b FROM c), r AS (SELECT node, node AS reached FROM nodes UNION SELECT r.node, v.y FROM r JOIN v ON v.x = r.reached),
    m AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
    SELECT component, CAST(count(*) AS BIGINT) AS members, CAST(min(year) AS INTEGER) AS earliest, CAST(max(year) AS INTEGER) AS latest FROM m LEFT JOIN works w ON w.work_id = m.node GROUP BY component"""
)
def cluster_summary(spark: SparkSession, d: str) -> DataFrame:
    """The clusters of coupled works: size and years."""
    y = _works(spark, d, "year").toDF("node", "year")
    return coupling_components(spark, d).join(y, "node", "left").groupBy("component").agg(F.count("*").alias("members"), F.min("year").alias("earliest"), F.max("year").alias("latest"))


@query()
def cluster_terms(spark: SparkSession, d: str) -> DataFrame:
    return T.cluster_terms(coupling_components(spark, d), _works(spark, d, "title").toDF("node", "title"))


@query(
    """WITH h AS (SELECT page_id, arg_min(text, block_no) AS heading FROM page_blocks WHERE kind = 'heading' GROUP BY page_id)
    SELECT p.page_id, coalesce(p.meta['citation_title'][1], h.heading, substr(split_part(p.text, chr(10), 1), 1, 200)) AS title,
    CASE WHEN p.meta['citation_title'][1] IS NOT NULL THEN 'metadata' WHEN h.heading IS NOT NULL THEN 'heading' ELSE 'first-line' END AS method FROM parsed_html p LEFT JOIN h USING (page_id)"""
)
def page_titles(spark: SparkSession, d: str) -> DataFrame:
    t = FD.titles(table(spark, d, "parsed_html", "page_id", "text", "meta"), table(spark, d, "page_blocks", "page_id", "block_no", "kind", "text"))
    return t.select("page_id", "title", "method")


@query()
def page_roles(spark: SparkSession, d: str) -> DataFrame:
    """Where the abstract, introduction, conclusion and references of each page are."""
    return FD.roles(table(spark, d, "page_blocks", "page_id", "block_no", "kind", "text", "container", "start_char", "end_char"))


@query(
    f"""WITH {_LAYERS}, s AS (SELECT node, layer FROM layers WHERE node NOT LIKE 'S-%')
    SELECT node, CAST(layer AS INTEGER) AS layer, lag(node) OVER (ORDER BY layer, node) AS previous, lead(node) OVER (ORDER BY layer, node) AS following FROM s"""
)
def reading_sequence(spark: SparkSession, d: str) -> DataFrame:
    """The reading order without the sequence nodes, each node with its neighbours."""
    layers = cut(dag_layers(spark, d))
    return RD.sequence(layers, layers.where("node like 'S-%'").select("node"))


@query(f"WITH {_LAYERS} SELECT node, CAST(28 + 210 * (row_number() OVER (PARTITION BY layer ORDER BY node) - 1) AS INTEGER) AS x, CAST(28 + 78 * layer AS INTEGER) AS y FROM layers")
def dag_layout(spark: SparkSession, d: str) -> DataFrame:
    return RD.layout(dag_layers(spark, d)).select("node", "x", "y")


@query(
    f"""WITH e AS (SELECT *, lead(ts) OVER w AS nxt, lag(ts) OVER w AS prv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(CASE WHEN prv IS NULL OR ts - prv >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e)
    SELECT user_id, min(ts) AS start, CAST(count(*) AS BIGINT) AS events FROM s GROUP BY user_id, k"""
)
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users with gaps under 30 minutes; the streaming form is in `refloom.streaming`."""
    s = table(spark, d, "events", "user_id", "ts").groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("events"))
    return s.select("user_id", F.col("w.start").alias("start"), "events")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
