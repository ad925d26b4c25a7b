import pandas as pd
from pyspark.sql import functions as F

from refloom.llm import name_variants as N


def test_lcs_ratio():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return 2 * t[-1][-1] / (len(a) + len(b))

    for a, b in [("salvilanov", "slvilanov"), ("abcdef", "fedcba"), ("x" * 200, "x" * 150 + "y" * 50), ("kalmawiton", "lemzeniton")]:
        assert N.lcs_ratio(a, b) == slow(a, b)
    assert N.lcs_ratio("", "") == 1 and N.lcs_ratio("a", "") == 0


def test_parse():
    assert N.parse(None) == [] and N.parse(" ., ") == []
    assert N.parse("van der Berg, Anna B.")[0] == ("p", "anna", "b", "vanderberg", False)
    assert N.parse("Anna B. van der Berg")[0] == ("p", "anna", "b", "vanderberg", False)
    assert ("x", "anna", "", "bergman", False) in N.parse("BERGMAN Anna")
    assert N.parse("Centre of Finite Spaces, Berg")[0][0] == "o"
    assert N.parse("a" * 5000)[0][3] == "a" * 5000


def same(a, b, rare=True, pets=((), ())):
    return max(N.compare(x, y, rare, set(pets[0]), set(pets[1])) for x in N.parse(a) for y in N.parse(b))


def test_variants():
    for a, b in [("Margaret Salvilanov", "Slvilanov, Margaret"), ("Veldenzor Jana", "Jana Veldenzor"), ("Flora E. Pertelgert", "Flora Pertelgert"), ("Gustav Delacalkahus", "Gustav de la Calkahus"), ("Lab. Fin. Spaces Grezabosk", "Laboratory of Finite Spaces, Grezabosk"), ("LFS Grezabosk", "Grezabosk Laboratory of Finite Spaces")]:
        assert same(a, b) == 2, (a, b)
    for a, b in [("Edward Kvarat", "Ekaterina Kvarat"), ("Flora E. Pert", "Flora M. Pert"), ("Centre of Finite Spaces, Kranoven", "Centre of Finite Spaces, Wenmigoton"), ("Rafael Zazedidt", "Rafael Monohust")]:
        assert same(a, b) == 0, (a, b)
    assert same("Bill Banalek", "William Banalek") == 0 and same("Bill Banalek", "William Banalek", pets=(["william"], ["william"])) == 2
    assert same("Xenia Madenbadt", "Xenia Madenpat", rare=False) == 1


def test_pet_names_are_learned_from_shared_works(spark):
    towns = [f"kra{a}{b}on" for a in "bdfgkl" for b in "aeiou"]
    rows = [(g, s, f"w{i}") for i, s in enumerate(towns[:4]) for g in ("bob", "robert")] + [(g, s, f"v{i}") for i, s in enumerate(towns) for g in (("robert", "anna", "karl", "ida")[i % 4],)]
    rows += [("anna", "krabaon", "one"), ("ida", "krabaon", "one"), ("j", "krabaon", "w0"), ("kim", "krabaon", None)] + [("ida", s, "w") for s in towns] + [("anna", s, "x") for s in towns]
    df = spark.createDataFrame(rows, "given string, surname string, work string")
    assert {r["given"]: r["pets"] for r in N.pet_names(df).collect()} == {"bob": ["robert"], "robert": ["robert"]}
    # a work that many bear the surname on says nothing
    crowd = spark.createDataFrame([(f"g{i}", "wang", "w") for i in range(50)], "given string, surname string, work string")
    assert N.pet_names(crowd).count() == 0


def test_pet_names_are_learned_from_crowds_under_several_surnames(spark):
    """25 given names bear the surname on a work: one such work says nothing, several that hold the same two names do."""
    towns = [f"kra{a}{b}on" for a in "bdfgkl" for b in "aeiou"]
    crowd = lambda i: [(g, towns[i], f"w{i}") for g in ("bob", "robert", *(f"x{i}{c}y" for c in "abcdefghijklmnopqrstuvw"))]
    other = [(f"{a}{b}m", f"{c}{d}lin", None) for a in "bdfgk" for b in "aeiou" for c in "bdfgk" for d in "aeiou"]
    learn = lambda rows: {r["given"]: r["pets"] for r in N.pet_names(spark.createDataFrame(rows, "given string, surname string, work string")).collect()}
    rows = [row for i in range(6) for row in crowd(i)] + [("robert", towns[9], None)]
    assert learn(rows + other) == {"bob": ["robert"], "robert": ["robert"]}
    assert learn(crowd(0) + other) == {}
    # a crowd of thousands has its pairs made row by row
    assert learn([(f"g{i}x", "wang", "w") for i in range(1500)] + rows + other) == {"bob": ["robert"], "robert": ["robert"]}


def test_links_and_groups(spark):
    rows = [(1, ["Jana Veldenzor", "J. Veldenzor"], ["w1", "w2", "w3"]), (2, ["Veldenzor Jana"], ["w1"]), (3, ["VELDENZOR, JANA"], ["w9"]), (4, ["Edward Kvarat"], ["w5"]), (5, ["Ekaterina Kvarat"], ["w6"]), (6, None, None), (7, [], []), (8, ["Ve1denzor, J."], ["w2"]), (2, ["Veldenzor Jana"], ["w1"]), (None, ["Jana Veldenzor"], [])]
    df = spark.createDataFrame(rows, "no long, names array<string>, works array<string>").withColumn("form", F.lit(1)).withColumn("given", F.lit(2))
    groups = {r["node"]: r["component"] for r in N.name_groups(N.link_names(df, "no", "names", "works")).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 8: 1}


def test_copies_make_a_star_and_crowds_lose_nothing(spark):
    rows = [(i, ["Jana Veldenzor"]) for i in range(60)] + [(100 + i, [f"Jana Kv{c}rat"]) for i, c in enumerate("aeiouy")]
    df = spark.createDataFrame(rows, "no long, names array<string>")
    links = N.link_names(df, "no", "names", crowd=1)
    groups = {r["node"]: r["component"] for r in N.name_groups(links).collect()}
    assert {groups[i] for i in range(60)} == {0} and links.where("b < 60").count() == 59


def test_pairs_are_judged_where_their_block_lies(spark, monkeypatch):
    """What is exchanged grows with the forms, not with their pairs; the verdicts are those of all pairs."""
    given = [f"a{b}{c}{d}x" for b in "bdfgkl" for c in "aeiou" for d in "lnrst"]
    rows = [(i, [f"{g.title()} Salvi{'l' if i % 3 else 'k'}anov"], ["w1"] if i % 50 == 0 else []) for i, g in enumerate(given)] + [(900, ["A. Salvilanov"], ["w1"]), (901, ["Veldanov, Abalx"], [])]
    seen = spark.sparkContext.accumulator(0)
    judge = N._judge

    def counted(crowd):
        def run(parts):
            for pdf in judge(crowd)((seen.add(len(p)), p)[1] for p in parts):
                yield pdf

        return run

    monkeypatch.setattr(N, "_judge", counted)
    N.link_names(spark.createDataFrame(rows, "no long, names array<string>, works array<string>"), "no", "names", "works").count()
    assert 0 < seen.value < 40 * len(rows) < len(rows) ** 2 / 2
    forms = {i: f for i, (_, names, _) in enumerate(rows) for f in N.parse(names[0])[:1]}
    about = {i: "\u0001".join((f[0], f[1], f[2], f[3], str(int(f[4])), "1", "")) for i, f in forms.items()}
    block = pd.DataFrame([("n", i, a) for i, a in about.items()], columns=["key", "form", "about"])
    got = {(f, g): v for out in judge(5)([block[:70], block[70:]]) for f, g, v in out.itertuples(index=False)}
    assert got == {(f, g): v for f in forms for g in forms if f < g and (v := N.compare(forms[f], forms[g], True))} and 1 < len(got) < 5000
    # a crowded work parts its names by what those that may be one share
    crowd = {(f, g) for out in judge(5)([block.assign(key="w1")]) for f, g, _ in out.itertuples(index=False)}
    assert crowd == set(got)


def test_crowded_surnames_lose_no_pet_names_or_slips(spark):
    given = [f"{a}{b}{c}x" for a in "abcdefgh" for b in "aeiou" for c in "lnr"]
    crowd = [(100 + i, [f"{g.title()} Salvilanov"], []) for i, g in enumerate(given)]
    other = [(300 + i, [f"{n} {a}{b}k{c}rtem"], []) for i, (n, a, b, c) in enumerate((n, a, b, c) for n in ("Robert", "Margaret", "William") for a in "BDFG" for b in "aeiu" for c in "aeo")]
    # what the pet names are learned from: other bearers under both names
    pairs = (("Robert", "Bob"), ("Margaret", "Peggy"), ("Johannes", "Hans"))
    other += [(800 + 40 * k + 10 * i + j, [f"{n} Kra{c}zam"], [f"w{k}{i}"]) for k, p in enumerate(pairs) for i, c in enumerate(("bo", "di", "fe", "gu")) for j, n in enumerate(p)]
    rows = [(1, ["Robert Salvilanov"], []), (2, ["Bob Salvilanov"], []), (3, ["Margaret Salvilanov"], []), (4, ["Slvilanov, Peggy"], []), (5, ["Hans Salvilanov"], ["w"]), (6, ["Johannes Saivilamov"], ["w"]), (7, ["William Veldenzor"], []), (8, ["William Veldanzor"], [])]
    df = spark.createDataFrame(rows + crowd + other, "no long, names array<string>, works array<string>")
    groups = {r["node"]: r["component"] for r in N.name_groups(N.link_names(df, "no", "names", "works")).collect()}
    assert [groups.get(i) for i in range(1, 9)] == [1, 1, 3, 3, 5, 5, 7, 7]


def test_crowded_organisations_meet_their_acronyms(spark):
    towns = [f"{a}{b}{c}vidon" for a in "BDFGKLMN" for b in "aeiou" for c in "lr"]
    rows = [(100 + i, [f"{k} of {t} Spaces, Grezabosk"]) for i, (k, t) in enumerate((k, t.title()) for k in ("Institute", "Society") for t in towns)]
    df = spark.createDataFrame([(1, ["LFS Grezabosk"]), (2, ["Grezabosk Laboratory of Finite Spaces"]), *rows], "no long, names array<string>")
    groups = {r["node"]: r["component"] for r in N.name_groups(N.link_names(df, "no", "names")).collect()}
    assert groups.get(1) == groups.get(2) == 1


def test_empty(spark):
    assert N.link_names(spark.createDataFrame([], "no long, names array<string>"), "no", "names").count() == 0
