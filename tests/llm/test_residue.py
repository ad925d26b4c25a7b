import random

import numpy as np
from pyspark.sql import functions as F

from refloom.llm import residue as R
from refloom.llm import residue_samples as S

NATURAL = ["The transfer matrix gives a bound for every lattice with twelve elements, and the proof follows the older pattern.", "Nous donnons une table des espaces jusqu'à la taille 43; la recherche utilise l'ancien décompte.", "Der Beweis benutzt die Dimension und eine einfache Abschätzung aller Ordnungen auf zwölf Punkten.", "El número de casos crece más rápido de lo esperado en la sección siguiente del trabajo."]
PROSE = NATURAL * 50
BAD = {
    1: "A study of {{title}} in the plane.", 2: "Abstract: ${INSERT ABSTRACT HERE}", 3: NATURAL[0] + " <%= author_name %> " + NATURAL[1], 4: "Lorem ipsum dolor sit amet, consectetur adipiscing elit sed do.", 5: "Text to follow.", 6: "Error 404: the page you asked for could not be found.",
    7: "Please allow JavaScript to read this item.", 8: NATURAL[2] * 200 + " Access denied. You do not have permission to view item 5. " + NATURAL[3] * 200, 9: "La página no pudo cargarse.", 10: "THE PAGE FAILED TO LOAD!", 11: "by undefined, published null", 12: "[[abstract]]",
}
GOOD = {100 + i: t for i, t in enumerate([*S.SPOKEN, *NATURAL, "Die Zahl «x» steht in {a}.", "A page [1] of <a, b>."])} | {200: None, 201: "", 202: "ab"}


def test_detects_and_spares(spark):
    rows = [*BAD.items(), *GOOD.items(), (1, BAD[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("clash")).withColumn("coverage", F.lit(1.0))
    got = R.detect(df, "doc_id", "text", PROSE).collect()
    assert {r["doc_id"] for r in got} == set(BAD)
    cover = {r["doc_id"]: r["coverage"] for r in got}
    assert all(0 < c <= 1 for c in cover.values()) and cover[5] > 0.9 and 0.001 < cover[8] < 0.01
    assert len({(r["doc_id"], r["kind"]) for r in got}) == len(got)


def test_neighbours_in_a_batch_do_not_mix(spark):
    rng = random.Random(1)
    rows = [(i, BAD[6] if i % 7 == 0 else rng.choice(NATURAL)) for i in range(300)]
    got = {r["doc_id"] for r in R.detect(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", PROSE).collect()}
    assert got == {i for i in range(300) if i % 7 == 0}


def test_models_separate_held_out_samples():
    half = R.fit(PROSE)
    fresh = ["This address took too long to answer.", "Enable scripts to see the references.", "La ficha 7 no está accesible ahora.", "Die Datei wurde verschoben."]
    assert all(any(R.passages(R.coded(t), half)[k] for k in R.WINDOWS) for t in fresh)
    spared = sum(not any(R.passages(R.coded(t), half).values()) for t in NATURAL)
    assert spared == len(NATURAL)


def test_the_models_decide(monkeypatch):
    model = R.fit(PROSE)
    flat = {kind: np.zeros_like(m) for kind, m in model.items()}
    silent = model | {"spoken": np.full_like(model["spoken"], -1)}
    found = lambda m, t: any(R.passages(R.coded(t), m).values())
    assert all(found(model, t) for t in BAD.values()) and not any(found(flat, t) for t in BAD.values())
    # without the model of speech about residue such speech is taken for it
    assert not any(found(model, t) for t in S.SPOKEN) and sum(found(silent, t) for t in S.SPOKEN) > 2


def test_coverage_excludes(spark):
    rows = [(1, "notice", 1, 20, 0.5), (2, "notice", 1, 20, 0.0001), (3, "mark", 1, 9, 0.00001)]
    df = spark.createDataFrame(rows, "doc_id long, kind string, passages int, covered long, coverage double")
    assert {r["doc_id"] for r in R.excluded(df).collect()} == {1, 3} and {r["doc_id"] for r in R.excluded(df, {"mark": 0.01, "notice": 0.6}).collect()} == set()


def test_codes_keep_offsets():
    t = "Ünïcödé “x” 12\n"
    assert len(R.coded(t)) == len(t) and bytes(R.coded("A1 b")) == b"a0 b"


def test_empty(spark):
    assert R.detect(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", []).count() == 0
    assert R.prose_sample(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text") == []


def test_models_are_fitted_on_all_records(spark, tmp_path):
    """What long records say in passing is prose; a sample of short ones has none of it."""
    said = "Please allow JavaScript to read this item."
    rows = [(i, (NATURAL[i % 4] + " " + said + " ") * 300) for i in range(8)] + [(100 + i, NATURAL[i % 4] * 3) for i in range(200)] + [(900, said), (901, BAD[6]), (902, None), (903, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert min(len(t) for i, t in rows if i < 100) > R.PROSE_CHARS
    assert {r["doc_id"] for r in R.p10_found(spark, str(tmp_path)).collect()} == {901}
    # counts are whole and alike however the records are parted
    whole = sum(R.tally([t]) for _, t in rows if t)
    assert all((R.tallied(df.repartition(n), "text") == whole).all() for n in (1, 7))
    model = R.fit(PROSE)
    clean = sum(R.tally([t]) for _, t in rows if t and not any(R.passages(R.coded(t), model).values()))
    assert (R.tallied(df, "text", model) == clean).all() and clean.sum() < whole.sum()
    assert R.detect(df.limit(0), "doc_id", "text").count() == 0
