"""Variant spellings of names typed by people: suffix blocking and longest-common-subsequence ratios.

Names are parsed to forms (given name, middle initials, surname; or the words of an organisation). A form is indexed by
the suffixes of its surname, or of each word of an organisation, and by its given name. A suffix that too many forms
share is left for a longer one. What this could part meets in other blocks, which hold however many forms there are: three
letters in a row of the surname with the initial or the name it is a form of, equal surnames with three letters of the given
name, a shared work, and a common suffix of an organisation's word with the other words' initials. Pairs in a block are compared where the block lies, so no pair is written or exchanged, by the ratio of
their longest common subsequence, with nicknames, initials, middle initials, reordered parts, abbreviations and
truncation taken into account. Which given names are forms of one name is learned from the rows themselves (`pet_names`). Equal forms are one form, so copies of a name make no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from refloom.functions.text import fold
from refloom.operators.components import components
from refloom.plans.materialize import cut, drop
from refloom.plans.skew import heavy_keys, lookup
from refloom.sources.tables import table

#: A block of more forms than this is refined.
CROWD = 30
SHORTEST, LONGEST = 4, 12
#: A form of so few works is rare, as slips are.
RARE = 2
#: The least ratio of surnames that `compare` takes, unless one is cut short.
LEAST = 0.7

#: Words of organisations' names, and words that carry nothing (fixed values).
ORGANISATION = set("institute inst centre center ctr cent laboratory lab society soc group grp wg university univ department dept academy acad office bureau association assoc council team".split())
STOP = set("of for at on the and de la du des fur f o".split()) - {"de", "la"}
PARTICLES = set("van von der den de la del di da d ten ter al el le mac mc zu zur of".split())

#: Two given names are forms of one name if their bearers of one surname share a work in this share of the rarer name's
#: surnames, and so many times as often as chance has it.
PET_SHARE, PET_LIFT = 0.1, 10.0
#: A work where more given names than this bear the surname says as much in all as one with so many: its pairs share that.
FEW = 20
#: What one meeting counts, in whole numbers, so that sums do not depend on their order.
MEETING = 1_000_000_000

_LETTERS = str.maketrans({"ø": "o", "æ": "ae", "œ": "oe", "ß": "ss", "ł": "l", "đ": "d", "’": "'"})


@lru_cache(maxsize=2_000)
def _masks(text: str) -> dict[str, int]:
    """The places of each letter as bits; kept, since a text meets many others in a row."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def lcs_ratio(a: str, b: str) -> float:
    """Twice the length of the longest common subsequence over both lengths; bit-parallel, 1 for two empty strings.

    It is the same both ways; `a` should be the text that meets many others.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    full = s = (1 << len(a)) - 1
    for x in map(_masks(a).get, b, repeat(0)):
        u = s & x
        s = (s + u | s - u) & full
    return 2 * (len(a) - s.bit_count()) / (len(a) + len(b))


def parse(name: str | None) -> list[tuple]:
    """The forms (kind, given, middle, surname, cut) of a name; none for null or a name without letters.

    kind is 'p' for a person and 'o' for an organisation, whose words are in surname; 'x' is the reading of an
    unmarked two-part name as surname and given name. cut tells that the surname may be cut short by a full stop.
    """
    if name is None:
        return []
    raw = re.sub(r"\s+", " ", name).strip(" ,;")
    s = fold(raw.translate(_LETTERS)).translate(_LETTERS)
    short = bool(re.search(r"[a-z]{3,}\.(,|$)", s))
    s = re.sub(r"[’'`´]", "", s)
    words = re.findall(r"[a-z0-9]+", s)
    if not words:
        return []
    acronym = re.match(r"([A-Z]{2,5}) (?=[^\W\d_]{4,})", raw)
    if acronym and "," not in raw and not any(w in ORGANISATION for w in words):
        return [("o", words[0], "", " ".join(words[1:]), False)]
    if any(w in ORGANISATION for w in words) and len(words) > 2:
        spelled = [v for w in words for v in (("working", "group") if w == "wg" else (w,))]
        return [("o", "", "", " ".join(w for w in spelled if w not in STOP), False)]
    if "," in s:
        last, _, first = s.partition(",")
        given = re.findall(r"[a-z0-9]+", first)
        surname = "".join(re.findall(r"[a-z0-9]+", last))
        if not surname:
            return []
        return [("p", given[0] if given else "", "".join(w[0] for w in given[1:] if w not in PARTICLES), surname, short)]
    parts = re.findall(r"[a-z0-9-]+", s)
    parts = [p.strip("-") for p in parts if p.strip("-")]
    if len(parts) == 1:
        return [("p", "", "", parts[0].replace("-", ""), short)]
    at = next((i for i, p in enumerate(parts[1:-1], 1) if len(p) > 1), len(parts) - 1)
    surname = "".join(parts[at:]).replace("-", "")
    forms = [("p", parts[0].replace("-", ""), "".join(p[0] for p in parts[1:at]), surname, short)]
    if all(len(p) > 1 for p in parts):
        forms.append(("x", parts[-1].replace("-", ""), "", "".join(parts[:-1]).replace("-", ""), False))
    return forms


def _given(a: str, b: str, pets_a: frozenset | set = frozenset(), pets_b: frozenset | set = frozenset()) -> int:
    """3 equal or forms of one name (pets: what each is a form of), 2 alike but for a slip, 1 an initial of the other, 0 unlike."""
    if not a or not b:
        return 0
    if len(a) == 1 or len(b) == 1:
        return int(a[0] == b[0])
    if a == b or pets_a & pets_b:
        return 3
    # in a name read the other way round these are surnames, so long ones must be closer
    return 2 if lcs_ratio(a, b) >= (0.8 if min(len(a), len(b)) <= 6 else 0.86) else 0


def _abbreviates(a: str, b: str) -> bool:
    """Whether the shorter of two words stands for the longer: a beginning of it, or a few of its letters in order."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if b.startswith(a):
        return len(a) >= 2
    if len(a) > 4 or a[0] != b[0]:
        return False
    rest = iter(b)
    return all(ch in rest for ch in a)


def _organisations(a: tuple, b: tuple) -> int:
    (_, ia, _, ta, _), (_, ib, _, tb, _) = a, b
    x, y = ta.split(), tb.split()
    if ia or ib:
        if ia and ib:
            return 2 if ia == ib and lcs_ratio(ta, tb) >= 0.85 else 0
        short, letters, long = (x, ia, y) if ia else (y, ib, x)
        for i, w in enumerate(long):
            if lcs_ratio("".join(short), w) >= 0.85 and "".join(v[0] for v in long[:i] + long[i + 1 :]) == letters:
                return 2
        return 0
    if len(x) != len(y) or len(x) > 12:
        return 0
    left, loose = list(y), 0
    for w in sorted(x, key=len, reverse=True):
        if w in left:
            left.remove(w)
            continue
        best = max(left, key=lambda v: (_abbreviates(w, v) and min(len(w), len(v)) >= 3, lcs_ratio(w, v), v))
        if not _abbreviates(w, best):
            if lcs_ratio(w, best) < 0.78:
                return 0
            loose += 1
        left.remove(best)
    return 2 if loose <= 1 else 0


def compare(a: tuple, b: tuple, rare: bool, pets_a: frozenset | set = frozenset(), pets_b: frozenset | set = frozenset()) -> int:
    """2: the forms name one entity; 1: they do if a work is shared; 3: or if no other entity is so close; 0: they do not.

    rare: one of the two is seldom seen, as slips are.
    """
    if (a[0] == "o") != (b[0] == "o"):
        return 0
    if a[0] == "o":
        return _organisations(a, b)
    (_, ga, ma, sa, ca), (_, gb, mb, sb, cb) = a, b
    if ma and mb and ma[0] != mb[0]:
        return 0
    g = _given(ga, gb, pets_a, pets_b)
    if not g:
        return 0
    r = lcs_ratio(sa, sb)
    if (ca or cb) and r < 1:
        head = sb.startswith(sa) if len(sa) <= len(sb) else sa.startswith(sb)
        if head and min(len(sa), len(sb)) >= 4:
            return 3 if g == 3 and rare else 1
        return int(r >= 0.88)
    if g == 3:
        if r == 1:
            return 2
        if rare and r >= (0.78 if min(len(sa), len(sb)) >= 6 else 0.88):
            return 2
        return int(r >= LEAST)
    if g == 2:
        return 2 if r == 1 and rare else int(r >= 0.85)
    return 3 if rare and r >= 0.78 else int(r >= 0.8)


def _forms(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        out = []
        for entity, names, n in zip(pdf["entity"], pdf["names"], pdf["n"], strict=True):
            seen = {f for name in (names if names is not None else []) for f in parse(name)}
            out += [(entity, *f, n) for f in sorted(seen)]
        yield pd.DataFrame(out, columns=["entity", "kind", "given", "middle", "surname", "cut", "n"])


def _grams(word: str) -> set[str]:
    """Runs of three letters; of up to five letters also the first and the last two, of fewer than three the word."""
    runs = {word[i : i + 3] for i in range(max(1, len(word) - 2))}
    return runs | {"^" + word[:2], word[-2:] + "$"} if 3 <= len(word) <= 5 else runs


def _classes(given: str, pets: list[str] | None) -> set[str]:
    """What given names that are equal, forms of one name or initials of each other share: the initial and the names they are forms of."""
    return {given[:1], *(f"#{p}" for p in (pets if pets is not None else ()))} if given else set()


def pet_names(people: DataFrame) -> DataFrame:
    """(given, pets): the names that each given name is a form of, learned from all rows of (given, surname, work).

    Bearers of one surname who share a work and have unlike given names mostly are one person written in two ways.
    Two given names are forms of one name if that happens on enough of the rarer one's surnames and more often than their
    frequencies explain; the commoner one stands for both. Names without such a partner give no row.

    All pairs count, however many given names a work has of one surname: a pair among k of them counts as one meeting up
    to FEW, and FEW (FEW - 1) / k (k - 1) of one beyond, of a surname's works the most. So one crowd never decides, but
    crowds under several surnames do. Names are paired row by row, so no row holds all pairs of a crowd.
    """
    full = people.where("length(given) > 1 and surname <> '' and work is not null").select("given", "surname", "work").distinct()
    at = full.groupBy("surname", "work").agg(F.array_sort(F.collect_set("given")).alias("names")).withColumn("k", F.size("names").cast("long")).where("k > 1")
    counts = F.least(F.lit(MEETING), F.expr(f"{MEETING * FEW * (FEW - 1)} div (k * (k - 1))"))
    each = at.select("surname", counts.alias("w"), "names", F.posexplode("names").alias("i", "g")).where("i + 1 < size(names)")
    pairs = each.select("surname", "w", "g", F.explode(F.expr("slice(names, i + 2, size(names))")).alias("h"))
    met = pairs.groupBy("surname", "g", "h").agg(F.max("w").alias("w")).groupBy("g", "h").agg(F.sum("w").alias("n"))
    met = cut(met)
    common = people.where("length(given) > 1 and surname <> ''").select("given", "surname").distinct().groupBy("given").agg(F.count("*").alias("c"))
    common = cut(common)
    total = common.agg(F.sum("c")).first()[0] or 1
    every = int(met.agg(F.sum(F.col("n").cast("decimal(20,0)"))).first()[0] or MEETING)
    both = met.join(common.toDF("g", "cg"), "g").join(common.toDF("h", "ch"), "h")
    both = both.withColumn("m", F.col("n") / MEETING)
    chance = 2.0 * (every / MEETING) * F.col("cg") * F.col("ch") / F.lit(float(total) * total)
    pet = both.where((F.col("n") >= MEETING) & (F.col("m") >= PET_SHARE * F.least("cg", "ch")) & (F.col("m") >= PET_LIFT * chance))
    pet = cut(pet.select("g", "h", F.when(F.col("cg") >= F.col("ch"), F.col("g")).otherwise(F.col("h")).alias("head")))
    rows = pet.select(F.col("g").alias("given"), "head").unionByName(pet.select(F.col("h").alias("given"), "head"))
    return rows.groupBy("given").agg(F.array_sort(F.collect_set("head")).alias("pets"))


def _keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of suffixes, the shortest first: (form, chain, step, key, refined key)."""
    for pdf in parts:
        out = []
        for form, kind, given, surname in zip(pdf["form"], pdf["kind"], pdf["given"], pdf["surname"], strict=True):
            if kind == "o":
                words = surname.split()
                for i, w in enumerate(words):
                    # abbreviations keep a word's initial, acronyms are made of them
                    others = "".join(sorted(given or (v[0] for v in words[:i] + words[i + 1 :])))
                    top = min(LONGEST, len(w))
                    low = min(SHORTEST, top)
                    for step, size in enumerate(range(low, top + 1)):
                        out.append((form, f"o{w[-low:]}:{w}:{others}", step, "o" + w[-size:], f"O{w[-low:]}|{others}" if size == low else None))
                continue
            for word, tag in ((surname, "s"), (given, "g")):
                if tag == "s" or len(given) > 1:
                    top = min(LONGEST, len(word))
                    for step, size in enumerate(range(min(SHORTEST, top), top + 1)):
                        out.append((form, tag + word, step, tag + word[-size:], None))
        yield pd.DataFrame(out, columns=["form", "chain", "step", "key", "refined"])


@pandas_udf(T.ArrayType(T.StringType()))
def _whole(kind: pd.Series, given: pd.Series, surname: pd.Series, pets: pd.Series) -> pd.Series:
    """The keys that hold however many forms share them."""
    out = []
    for k, g, s, p in zip(kind, given, surname, pets, strict=True):
        near = [] if k == "o" else [f"n{x}|{c}" for x in sorted(_grams(s)) for c in sorted(_classes(g, p))]
        out.append(near + ([f"e{s}|{x}" for x in sorted(_grams(g))] if k != "o" and len(g) > 1 else []))
    return pd.Series(out, dtype=object)


def _letters(word: str) -> int | None:
    """A bit for each letter and how often it came before; two words have no longer common subsequence than bits in common."""
    bits, seen = 0, dict.fromkeys(word, 0)
    for ch in word:
        bits |= 1 << (ord(ch) * 16 + seen[ch])
        seen[ch] += 1
    return bits if max(seen.values(), default=0) <= 16 else None


class _Form:
    """A form as blocks carry it, in one text."""

    __slots__ = ("form", "pets", "rare", "bits", "is_org", "middle", "size", "given")

    def __init__(self, about: str) -> None:
        kind, given, middle, surname, short, rare, pets = about.split("\u0001")
        self.form = (kind, given, middle, surname, short == "1")
        self.pets, self.rare, self.is_org = frozenset(pets.split(" ") if pets else ()), rare == "1", kind == "o"
        self.middle, self.size, self.given = middle[:1], len(surname), given
        # a surname cut short need not be as long
        self.bits = None if self.is_org or short == "1" else _letters(surname)

    def verdict(self, other: _Form) -> int:
        """`compare`; most pairs are told apart by their letters, of which LEAST of both names' must be common."""
        if self.is_org != other.is_org or (self.middle and other.middle and self.middle != other.middle):
            return 0
        if self.bits is not None and other.bits is not None and 2 * (self.bits & other.bits).bit_count() < LEAST * (self.size + other.size):
            return 0
        return compare(self.form, other.form, self.rare or other.rare, self.pets, other.pets)


def _block(key: str, forms: dict[int, _Form], crowd: int) -> Iterator[tuple[int, int, int]]:
    """(f, g, verdict) of the pairs in a block. A crowded work is parted by what given names that may be one share."""
    if key[0] == "w" and len(forms) > crowd:
        part: dict[str, dict[int, _Form]] = {}
        for i, x in forms.items():
            for c in _classes(x.given, sorted(x.pets)) | (_grams(x.given) if len(x.given) > 1 else set()):
                part.setdefault(c, {})[i] = x
        for some in part.values():
            yield from _block("-", some, crowd)
        return
    rows = sorted(forms.items())
    for at, (f, x) in enumerate(rows):
        for k in range(at + 1, len(rows)):
            g, y = rows[k]
            if v := x.verdict(y):
                yield f, g, v


def _judge(crowd: int):
    """Rows (key, form, about) in the order of their keys to the pairs of each block; a task holds one block."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, forms, known = None, {}, {}
        for pdf in parts:
            out: list[tuple] = []
            for key, form, about in zip(pdf["key"], pdf["form"], pdf["about"], strict=True):
                if key != last:
                    if len(forms) > 1:
                        out += _block(last, forms, crowd)
                    last, forms = key, {}
                x = known.get(form)
                if x is None:
                    if len(known) > 50_000:
                        known.clear()
                    x = known[form] = _Form(about)
                forms[form] = x
            yield pd.DataFrame(out, columns=["f", "g", "verdict"])
        if len(forms) > 1:
            yield pd.DataFrame(list(_block(last, forms, crowd)), columns=["f", "g", "verdict"])

    return run


def link_names(records: DataFrame, entity: str, names: str, works: str | None = None, crowd: int = CROWD) -> DataFrame:
    """(a, b) with a < b: links between entities that are spellings of one person or organisation.

    `names` holds the spellings of an entity, `works` what else it is seen with. Null or empty names give no form and no
    link; spellings are read whole, whatever their length; repeated rows of an entity are merged. Entities that share a
    full name are linked to the smallest of them, not to each other. Ties do not arise: links are unordered.
    """
    cols = records.select(F.col(entity).alias("entity"), F.col(names).alias("names"), (F.col(works) if works else F.array().cast("array<string>")).alias("works"))
    one = cols.where("entity is not null").groupBy("entity").agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"), F.array_distinct(F.flatten(F.collect_list("works"))).alias("works"))
    one = cut(one)
    key_type = one.schema["entity"].dataType.simpleString()
    parsed = one.select("entity", "names", F.size("works").alias("n")).mapInPandas(_forms, f"entity {key_type}, kind string, given string, middle string, surname string, cut boolean, n int")
    member = cut(parsed.withColumn("form", F.xxhash64("kind", "given", "middle", "surname", "cut")))
    bare = cut(member.groupBy("form").agg(*[F.first(c).alias(c) for c in ("kind", "given", "middle", "surname", "cut")], F.min("n").alias("n"), F.min("entity").alias("head")))
    worked = member.where("kind = 'p'").select("entity", "given", "surname").join(one.select("entity", F.explode_outer("works").alias("work")), "entity")
    pets = cut(pet_names(worked))
    common = bare.groupBy("given").agg(F.count("*").alias("c"))
    named = lookup(bare, pets, "given", heavy_keys(common, "given", "c", bare.count()), "left")
    forms = cut(named.withColumn("pets", F.coalesce("pets", F.array().cast("array<string>"))))

    keys = cut(forms.select("form", "kind", "given", "surname").mapInPandas(_keys, "form long, chain string, step int, key string, refined string"))
    size = keys.groupBy("key").agg(F.count("*").alias("size"))
    sized = cut(keys.join(size, "key"))
    drop(keys)
    # a suffix is used where it is not crowded and the one before it was
    first = sized.where(F.col("size") <= crowd).groupBy("form", "chain").agg(F.min(F.struct("step", "key")).alias("m")).select("form", F.col("m.key").alias("key"))
    refined = sized.where((F.col("size") > crowd) & F.col("refined").isNotNull()).select("form", F.col("refined").alias("key"))
    about = F.concat_ws("\u0001", "kind", "given", "middle", "surname", F.col("cut").cast("int"), (F.col("n") <= RARE).cast("int"), F.array_join("pets", " ")).alias("about")
    told = forms.select("form", about)
    whole = forms.select(F.explode(_whole("kind", "given", "surname", "pets")).alias("key"), "form", about)
    # a weak pair counts only where a work is shared, so the works' blocks hold all of these
    met = member.where("kind <> 'o' and given <> ''").select("form", "entity").join(one.select("entity", F.explode("works").alias("work")), "entity").select(F.concat(F.lit("w"), "work").alias("key"), "form").distinct()
    blocks = first.unionByName(refined).distinct().unionByName(met).join(told, "form").select("key", "form", "about").unionByName(whole)
    verdicts = cut(blocks.repartition("key").sortWithinPartitions("key").mapInPandas(_judge(crowd), "f long, g long, verdict int").distinct())
    drop(sized)

    heads = forms.select("form", "head")
    strong = verdicts.where("verdict = 2").join(heads.toDF("f", "a"), "f").join(heads.toDF("g", "b"), "g").select("a", "b")
    full = member.where("kind = 'o' or length(given) > 1").join(forms.select("form", "head"), "form").select(F.col("head").alias("a"), F.col("entity").alias("b"))
    # a weak pair of forms counts where a work is shared; the works of both sides meet per pair and work
    weak = verdicts.where("verdict <> 2").select("f", "g")
    own = member.select("form", "entity").distinct().join(one.select("entity", F.explode("works").alias("work")), "entity")
    left = weak.join(own.toDF("a", "f", "work"), "f")
    right = weak.join(own.toDF("b", "g", "work"), "g")
    shared = left.join(right, ["f", "g", "work"]).select("a", "b")
    links = strong.unionByName(full).unionByName(shared).where("a <> b")
    links = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # a name with only an initial, or cut short, that is in no group and close to exactly one so far joins it
    groups = cut(components(links, "a", "b"))
    loose = verdicts.where("verdict = 3")
    both = loose.select("f", "g").unionByName(loose.select(F.col("g").alias("f"), F.col("f").alias("g")))
    initial = forms.where("length(given) = 1 or cut").select(F.col("form").alias("f"), F.col("head").alias("a"))
    near = both.join(initial, "f").join(heads.toDF("g", "b"), "g")
    near = near.join(groups.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("component", "b").alias("b"))
    near = near.where("a <> b").join(groups.select(F.col("node").alias("a")), "a", "left_anti")
    only = near.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("top")).where("b = top").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return links.unionByName(only).distinct()


def name_groups(links: DataFrame) -> DataFrame:
    """(node, component): the groups that links make together."""
    return components(links, "a", "b")


def _authors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "author_rankings", "author_no", "display_names", "works")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    groups = cut(name_groups(link_names(_authors(spark, d), "author_no", "display_names", "works")))
    a = groups.select("component", F.col("node").alias("author_no_a"))
    b = groups.select("component", F.col("node").alias("author_no_b"))
    return a.join(b, "component").where("author_no_a < author_no_b").select("author_no_a", "author_no_b")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row for each author row: the smallest author_no of its group and the group's size."""
    rows = _authors(spark, d)
    groups = name_groups(link_names(rows, "author_no", "display_names", "works"))
    every = rows.select("author_no").distinct().join(groups.withColumnRenamed("node", "author_no"), "author_no", "left").select("author_no", F.coalesce("component", "author_no").alias("group_no"))
    every = cut(every)
    return every.join(every.groupBy("group_no").agg(F.count("*").alias("members")), "group_no")


def p3_reference_names(spark: SparkSession, d: str) -> DataFrame:
    """(name, group_no): each different name in parsed_refs.authors with the smallest author_no it is a spelling of."""
    authors = _authors(spark, d).select(F.concat(F.lit("a"), F.lpad("author_no", 12, "0")).alias("entity"), F.col("display_names").alias("names"), "works")
    refs = table(spark, d, "parsed_refs", "authors").select(F.explode("authors").alias("name")).where("name is not null").distinct()
    named = refs.select(F.concat(F.lit("r"), F.col("name")).alias("entity"), F.array("name").alias("names"), F.array().cast("array<string>").alias("works"))
    groups = name_groups(link_names(authors.unionByName(named), "entity", "names", "works"))
    out = groups.where("startswith(node, 'r') and startswith(component, 'a')")
    return out.select(F.substring("node", 2, 2147483647).alias("name"), F.substring("component", 2, 12).cast("long").alias("group_no"))


def queries() -> dict:
    return {"p3_found": p3_found, "p3_groups": p3_groups, "p3_reference_names": p3_reference_names}


def oracle_sql() -> dict[str, str]:
    return {}
