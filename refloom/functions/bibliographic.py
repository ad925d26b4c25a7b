"""Bibliographic scalars as Column expressions: identifiers, names, reference strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refloom.functions.text import folded


def match_key(text: Column) -> Column:
    """Folded text with runs of anything but a-z and 0-9 as one blank, trimmed; null stays null."""
    return F.trim(F.regexp_replace(folded(text), r"[^a-z0-9]+", " "))


def local_id(basis: Column) -> Column:
    """A stable identifier for what has none: `local:` and the SHA-256 of the match key."""
    return F.concat(F.lit("local:"), F.sha2(match_key(basis), 256))


def doi(value: Column) -> Column:
    """The bare lower-case DOI in a string, without trailing punctuation; null if there is none."""
    found = F.regexp_extract(value, r"(?i)\b(10\.\d{4,9}/[-._;()/:a-z0-9<>\[\]]+)", 1)
    return F.nullif(F.lower(F.regexp_replace(found, r"[.,;:)\]>\"']+$", "")), F.lit(""))


def isbn13(value: Column) -> Column:
    """The ISBN-13 of a valid ISBN-10 or ISBN-13, null for anything else."""
    raw = F.upper(F.regexp_replace(value, r"[\s-]", ""))
    digits = lambda s, n: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.substring(s, i.cast("int"), F.lit(1)))
    num = lambda d: F.when(d == "X", 10).otherwise(F.expr("0") + F.coalesce(d.try_cast("int"), F.lit(0)))
    ten = F.aggregate(F.transform(digits(raw, 10), lambda d, i: num(d) * (10 - i)), F.lit(0), lambda a, x: a + x)
    weigh = lambda s, n: F.aggregate(F.transform(digits(s, n), lambda d, i: num(d) * F.when(i % 2 == 0, 1).otherwise(3)), F.lit(0), lambda a, x: a + x)
    stem = F.concat(F.lit("978"), F.substring(raw, 1, 9))
    from_ten = F.concat(stem, ((10 - weigh(stem, 12) % 10) % 10).cast("string"))
    return F.when(raw.rlike(r"^\d{9}[\dX]$") & (ten % 11 == 0), from_ten).when(raw.rlike(r"^\d{13}$") & (weigh(raw, 13) % 10 == 0), raw)


def surname(name: Column) -> Column:
    """What stands before a comma, else the last word that is not a bare initial; null for null."""
    parts = F.filter(F.split(F.trim(name), r"\s+"), lambda w: ~w.rlike(r"^\p{L}\.?$"))
    last = F.when(F.size(parts) > 0, F.element_at(parts, -1)).otherwise(F.trim(name))
    return F.when(F.contains(name, F.lit(",")), F.trim(F.split_part(name, F.lit(","), F.lit(1)))).otherwise(last)


def given_names(name: Column) -> Column:
    """The part of a name that `surname` leaves."""
    before = F.trim(F.regexp_replace(F.trim(name), r"\s*\S+$", ""))
    return F.when(F.contains(name, F.lit(",")), F.trim(F.regexp_replace(name, r"^[^,]*,", ""))).otherwise(before)


def author_key(name: Column) -> Column:
    """The match key of the surname and the initials of the given names: one key for the usual ways to write a name."""
    initials = F.transform(F.filter(F.split(match_key(given_names(name)), " "), lambda w: w != ""), lambda w: F.substring(w, 1, 1))
    return F.trim(F.concat_ws(" ", match_key(surname(name)), F.array_join(initials, " ")))


def seed_group(alias: Column, pattern: str = r"^([A-Za-z]+)") -> Column:
    """The group of a work by its alias: the pattern's first group in upper case, null where it does not match."""
    return F.nullif(F.upper(F.regexp_extract(alias, pattern, 1)), F.lit(""))


def surname_key(author_id: Column) -> Column:
    """The first word of an author's name key."""
    return F.split_part(F.regexp_replace(author_id, "^author:", ""), F.lit(" "), F.lit(1))


def discovered_id(doi_: Column, isbn: Column, basis: Column) -> Column:
    """The identifier of a work found in references: by DOI, else ISBN, else the hash of what is known."""
    return F.coalesce(F.concat(F.lit("doi:"), doi_), F.concat(F.lit("isbn:"), isbn), local_id(basis))


_NAME = r"[A-Z][\p{L}\p{N}_'-]+,\s*(?:[A-Z]\.\s*){1,3}|(?:[A-Z]\.\s*){1,3}[A-Z][\p{L}\p{N}_'-]+".replace("'", "’")
_BETWEEN = r"\s*(?:, *[Aa]nd\b|,|;|\b[Aa]nd\b|&|\.)\s*"
#: A name with initials at the beginning of a list, and one after another name and what parts them.
FIRST_NAME, NEXT_NAME = rf"^({_NAME})", rf"^{_BETWEEN}({_NAME})"
#: What follows the word ISBN and has its shape.
MARKED_ISBN = r"ISBN(?:-1[03])?:?\s*((?:97[89][- ]?)?\d[- \d]{8,}[\dXx])\b"
_MARKER = r"^\s*(?:\[\d{1,3}\]|\(\d{1,3}\)|\d{1,3}\.)\s*"


def reference_authors(raw: Column) -> Column:
    """The names with initials that a reference string begins with, in order; none for null.

    One expression walks the list: each match must begin where the one before ended.
    """
    body = F.regexp_replace(raw, _MARKER, "")
    found = F.regexp_extract_all(body, F.lit(rf"(?:^|\G(?!^){_BETWEEN})({_NAME})"), F.lit(1))
    return F.transform(found, lambda n: F.trim(F.regexp_replace(n, r",\s*", ", ")))


def isbn_shaped(raw: Column) -> Column:
    """Whether something of an ISBN's shape stands after that word."""
    return raw.rlike(MARKED_ISBN)


def parsed_reference(raw: Column) -> Column:
    """struct(doi, url, year, volume, issue, pages, title, authors, isbn, warnings) of a reference string.

    The year is the last number from 1500 to 2099 outside identifiers. volume(issue):pages is read as such, else a page
    range alone. A quoted run of 8 to 300 characters is the title, else the first sentence-like part that follows the names.
    """
    s = F.regexp_replace(raw, r"^\s*(?:\[\d+\]|\(?\d+[.)])\s*", "")
    d = doi(s)
    url = F.nullif(F.regexp_replace(F.regexp_extract(s, r"(https?://\S+)", 1), r"[.,;)]+$", ""), F.lit(""))
    clean = F.regexp_replace(s, r"(?i)https?://\S+|(?:doi:?\s*)?\b10\.\d{4,9}/\S+|isbn[:\s]*[\dxX -]{10,17}", " ")
    years = F.regexp_extract_all(clean, F.lit(r"\b(1[5-9]\d\d|20\d\d)\b"), F.lit(1))
    year = F.when(F.size(years) > 0, F.element_at(years, -1)).cast("int")
    vip = r"(\d+)\s*\((\d+)\)\s*[:,]?\s*(\d+)\s*[-–]\s*(\d+)"
    volume, issue = F.nullif(F.regexp_extract(clean, vip, 1), F.lit("")), F.nullif(F.regexp_extract(clean, vip, 2), F.lit(""))
    pages = F.nullif(F.regexp_replace(F.regexp_extract(clean, r"\b(\d{1,5}\s*[-–]\s*\d{1,5})\b", 1), r"\s*[-–]\s*", "-"), F.lit(""))
    quoted = F.nullif(F.regexp_extract(clean, r"[\"“«]([^\"”»]{8,300})[\"”»]", 1), F.lit(""))
    # the list of names at the beginning is no part of the title
    rest = F.regexp_replace(F.regexp_replace(clean, rf"^(?:{_NAME})(?:{_BETWEEN}(?:{_NAME}))*", ""), r"^[ .,;:&]+", "")
    parts = F.filter(F.split(rest, r"(?<!\b\p{Lu})\.\s+|:\s+"), lambda p: (F.length(F.trim(p)) >= 8) & ~p.rlike(r"^\s*\d{4}\s*$") & (F.size(F.split(F.trim(p), r"\s+")) >= 3))
    # a part of nothing but capitalised words, initials and particles reads as names, unless there is no other
    names = r"^\s*(?:(?:\p{Lu}[\p{L}'’-]*\.?|and|y|et|und|&|van|von|der|de|la|ten|al|al\.)[,;]?\s*)+$"
    other = F.get(F.filter(parts, lambda p: ~p.rlike(names)), F.lit(0))
    title = F.coalesce(F.regexp_replace(quoted, r"[,.\s]+$", ""), F.nullif(F.trim(F.coalesce(other, F.get(parts, F.lit(0)))), F.lit("")))
    isbn = isbn13(F.regexp_extract(raw, MARKED_ISBN, 1))
    warned = F.array(F.when(isbn_shaped(raw) & isbn.isNull(), "isbn-checksum"), F.when(title.isNull(), "no-title"))
    warnings = F.filter(warned, lambda w: w.isNotNull())
    return F.struct(d.alias("doi"), url.alias("url"), year.alias("year"), volume.alias("volume"), issue.alias("issue"), pages.alias("pages"), title.alias("title"), reference_authors(raw).alias("authors"), isbn.alias("isbn"), warnings.alias("warnings"))


def citation_metadata(meta: Column) -> Column:
    """struct(title, authors, year, doi) of a page's metadata: the first value of each name wins."""
    get = lambda *names: F.coalesce(*[F.get(F.try_element_at(meta, F.lit(n)), F.lit(0)) for n in names])
    authors = F.coalesce(F.try_element_at(meta, F.lit("citation_author")), F.try_element_at(meta, F.lit("dc.creator")), F.array().cast("array<string>"))
    year = F.nullif(F.regexp_extract(get("citation_publication_date", "citation_date", "citation_year", "dc.date"), r"(\d{4})", 1), F.lit(""))
    return F.struct(get("citation_title", "dc.title").alias("title"), authors.alias("authors"), year.cast("int").alias("year"), get("citation_doi", "dc.identifier").alias("doi"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; null where both are empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def match_score(title_a: Column, title_b: Column, year_a: Column, year_b: Column, same_author: Column) -> Column:
    """0.80 x Jaccard of the titles' words, 0.12 for the year, -0.25 for one more than 1 off, 0.10 for the first author; in [0, 0.99]."""
    a, b = F.split(match_key(title_a), " "), F.split(match_key(title_b), " ")
    years = F.when(year_a == year_b, 0.12).when(F.abs(year_a - year_b) > 1, -0.25).otherwise(0.0)
    score = 0.8 * jaccard(F.array_distinct(a), F.array_distinct(b)) + years + F.when(same_author, 0.1).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(0.99), score))


def host(url: Column) -> Column:
    """The host of a URL in lower case."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """The path of a URL with `.` and `..` resolved, without query and fragment."""
    raw = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    step = lambda acc, part: F.when(part == "..", F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).when(part.isin(".", ""), acc).otherwise(F.array_append(acc, part))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(raw, "/"), F.array().cast("array<string>"), step), "/"))


def safe_segment(value: Column) -> Column:
    """A path segment of letters, digits, dot, underscore and hyphen, at most 120 long; null for what could leave its folder."""
    bad = value.isin("", ".", "..") | value.rlike(r"[/\\\x00]")
    return F.when(~bad, F.substring(F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "-"), r"^[-.]+|[-.]+$", ""), 1, 120))
