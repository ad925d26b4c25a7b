"""Rules of manifests: rights, members, assets, nodes, choices and built pages. Each is a filter, an anti-join or a count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.operators.validate import all_issues, issue, rule

#: Controlled vocabularies (fixed values).
ASSET_ROLES = ("landing", "fulltext", "metadata", "mirror", "preview", "borrow")
ACQUISITION_INTENTS = ("required", "fallback", "metadata_only", "manual", "ignore")
NODE_KINDS = ("work", "choice", "collection")
CONTENT_ROLES = ("fulltext", "metadata", "mirror")


def _unknown(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The rows whose `key` (not null) is no value of the first column of `known`."""
    names = known.select(F.col(known.columns[0]).alias("_known")).where("_known is not null").distinct()
    return rows.where(F.col(key).isNotNull()).join(names, F.col(key) == F.col("_known"), "left_anti")


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def rights_issues(works: DataFrame) -> DataFrame:
    """Rules of rights (work_id, publish_abstract, publish_fulltext, license_evidence_url, local_storage_allowed); null flags are false."""
    at, full = F.col("work_id"), F.coalesce("publish_fulltext", F.lit(False))
    bare = _blank(F.col("license_evidence_url"))
    return all_issues(
        rule(works, full & bare, "error", "publish-without-evidence", at),
        rule(works, F.coalesce("publish_abstract", F.lit(False)) & bare, "error", "publish-without-evidence", at),
        rule(works, full & ~F.coalesce("local_storage_allowed", F.lit(False)), "error", "publish-without-storage", at),
    )


def membership_issues(works: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Rules of membership (work_id, work_type, aliases, members, container); `expected` lists aliases that must exist."""
    alias = works.select(F.explode("aliases").alias("alias"))
    member = works.select("work_id", F.explode("members").alias("member"))
    parts = [
        rule(works, (F.col("work_type") == "collection") & (F.coalesce(F.size("members"), F.lit(0)) <= 0), "error", "empty-collection", F.col("work_id")),
        issue(_unknown(member, "member", alias), "error", "dangling-member", F.col("work_id")),
        issue(_unknown(works.where("container <> ''"), "container", alias), "error", "dangling-container", F.col("work_id")),
    ]
    if expected is not None:
        parts.append(issue(_unknown(expected, expected.columns[0], alias), "error", "missing-seed-alias", F.col(expected.columns[0])))
    return all_issues(*parts)


def asset_issues(assets: DataFrame) -> DataFrame:
    """Rules of assets (work_id, asset_id, role, intent, url, min_bytes). Of assets with one id or URL all but the first count as repeated."""
    at = F.concat_ws("/", "work_id", "asset_id")
    has = ~_blank(F.col("url"))

    def again(rows: DataFrame, key: str, severity: str, code: str) -> DataFrame:
        # the first by place is told from the rest by an aggregation, so no key's rows gather in a window
        first = rows.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct("work_id", "asset_id")).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
        met = rows.join(first, F.col(key) == F.col("_key"))
        rest = met.where(F.struct("work_id", "asset_id") != F.col("_first"))
        return issue(rest, severity, code, at)

    return all_issues(
        again(assets, "asset_id", "error", "duplicate-asset-id"),
        rule(assets, ~F.coalesce(F.col("role").isin(*ASSET_ROLES), F.lit(False)), "error", "bad-role", at),
        rule(assets, ~F.coalesce(F.col("intent").isin(*ACQUISITION_INTENTS), F.lit(False)), "error", "bad-intent", at),
        rule(assets, (F.coalesce("intent", F.lit("")) != "ignore") & ~has, "error", "missing-url", at),
        again(assets.where(has), "url", "warning", "duplicate-url"),
        rule(assets, has & ~F.col("url").rlike("^https?://"), "error", "bad-url-scheme", at),
        rule(assets, F.col("min_bytes") < 1, "error", "bad-min-bytes", at),
        rule(assets, (F.col("intent") == "required") & ~F.coalesce(F.col("role").isin(*CONTENT_ROLES), F.lit(False)), "error", "required-non-content", at),
    )


def node_issues(nodes: DataFrame, works: DataFrame) -> DataFrame:
    """Rules of nodes (node_id, kind, ref, options) beside works (work_id, aliases)."""
    at = F.col("node_id")
    names = works.select(F.col("work_id").alias("name")).unionByName(works.select(F.explode("aliases").alias("name")))
    refers = F.col("kind").isin("work", "collection")
    options = nodes.where("kind = 'choice'").select("node_id", F.explode("options").alias("option"))
    primary = works.select("work_id", F.coalesce(F.get("aliases", F.lit(0)), "work_id").alias("alias"))
    ref = nodes.select("ref")
    return all_issues(
        issue(nodes.groupBy("node_id").agg(F.count("*").alias("n")).where("n > 1"), "error", "duplicate-node", at),
        rule(nodes, ~F.coalesce(F.col("kind").isin(*NODE_KINDS), F.lit(False)), "error", "bad-node-kind", at),
        rule(nodes, refers & F.col("ref").isNull(), "error", "node-missing-ref", at),
        issue(_unknown(nodes.where(refers), "ref", names), "error", "dangling-ref", at),
        rule(nodes, (F.col("kind") == "choice") & (F.coalesce(F.size("options"), F.lit(0)) < 2), "error", "degenerate-choice", at),
        issue(_unknown(options, "option", nodes.select("node_id")), "error", "dangling-choice-option", at),
        issue(_unknown(_unknown(primary, "work_id", ref), "alias", ref), "warning", "work-not-in-dag", F.col("alias")),
    )


def choice_issues(nodes: DataFrame, profile: DataFrame) -> DataFrame:
    """Rules of a reading profile (choice_id, selected) beside the nodes (node_id, kind, options)."""
    choices = nodes.where("kind = 'choice'").select(F.col("node_id").alias("choice_id"), "options")
    picked = profile.join(choices, "choice_id")
    at = F.col("choice_id")
    return all_issues(
        issue(_unknown(profile, "choice_id", choices), "error", "unknown-choice", at),
        rule(picked, ~F.array_contains("options", F.col("selected")), "error", "bad-choice-selection", at),
        issue(_unknown(choices, "choice_id", profile), "warning", "choice-not-in-profile", at),
        rule(picked, F.col("selected").isNull(), "warning", "choice-unselected", at),
    )


def page_issues(pages: DataFrame, links: DataFrame, anchors: DataFrame) -> DataFrame:
    """Rules of built pages: pages (path, title, inline_scripts), links (path, href), anchors (path, anchor).

    A link with a scheme must be http, https or mailto, one without must be relative and lead to a page and an anchor
    that exist. An empty set of pages is an issue of its own.
    """
    href = links.select("path", "href", F.regexp_extract("href", r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1).alias("scheme"))
    local = href.where("scheme = ''").select("path", "href", F.regexp_extract("href", r"^([^#?]*)", 1).alias("to"), F.regexp_extract("href", r"#(.*)$", 1).alias("anchor"))
    # ./ and the folder of the linking page are resolved before the join
    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    target = F.when(F.col("to") == "", F.col("path")).otherwise(F.regexp_replace(F.concat(folder, F.regexp_replace("to", r"^(?:\./)+", "")), r"[^/]+/\.\./", ""))
    inner = local.where(~F.col("to").startswith("/")).withColumn("target", target)
    at = F.concat_ws(" ", "path", "href")
    known = pages.select(F.col("path").alias("target"))
    there = anchors.select(F.concat_ws("#", "path", "anchor").alias("spot"))
    spots = inner.where("anchor <> ''").join(known.distinct(), "target", "left_semi").withColumn("spot", F.concat_ws("#", "target", "anchor"))
    none = pages.agg(F.count("*").alias("n")).where("n = 0")
    return all_issues(
        issue(none, "error", "empty-site", F.lit("site")),
        rule(pages, _blank(F.trim("title")), "error", "missing-title", F.col("path")),
        rule(pages, F.col("inline_scripts") > 0, "error", "inline-script", F.col("path")),
        issue(href.where(~F.lower("scheme").isin("", "http", "https", "mailto")), "error", "bad-link-scheme", at),
        issue(local.where(F.col("to").startswith("/")), "error", "absolute-link", at),
        issue(_unknown(inner, "target", known), "error", "broken-link", at),
        issue(_unknown(spots, "spot", there), "error", "broken-anchor", at),
    ).distinct()
