import math
import unicodedata
import re
from collections import Counter

from pyspark.sql import functions as F

from refloom.llm import distinctive_terms as D

TITLES = [("a", "Lattices and Lattices over Möbius fields"), ("b", "lattices & posets"), ("c", "Mobius posets: the ½ case"), ("d", None), ("e", ""), ("f", "x y"), ("b", "lattices & posets"), (None, "lost lattices"), ("g", "Lattices"), ("h", "posets " * 3000)]


def brute(titles):
    one = {}
    for i, t in titles:
        if i is not None:
            one[i] = min((x for x in (one.get(i), t) if x is not None), default=None)
    words = {}
    for i, t in one.items():
        s = "".join(ch for ch in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(ch)).lower()
        c = Counter(re.findall("[a-z0-9]{3,}", s))
        if c:
            words[i] = c
    df, cf = Counter(), Counter()
    for c in words.values():
        df.update(c.keys())
        cf.update(c)
    n, mean = len(words), sum(map(sum, (c.values() for c in words.values()))) / len(words)
    out = {}
    for i, c in words.items():
        for t, tf in c.items():
            rate, tfn = cf[t] / n, tf * math.log2(1 + mean / sum(c.values()))
            out[i, t] = (tf, df[t], (math.log2(1 + rate) + tfn * math.log2((1 + rate) / rate)) / (tfn + 1))
    return out


def test_scores_equal_the_formula(spark):
    df = spark.createDataFrame(TITLES, "id string, title string").withColumn("term", F.lit("clash")).withColumn("tf", F.lit(1))
    got = {(r["record_id"], r["term"]): (r["tf"], r["df"], r["score"]) for r in D.term_scores(df, "id", "title").collect()}
    want = brute(TITLES)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:2] == want[k][:2] and math.isclose(got[k][2], want[k][2], rel_tol=1e-9)


def test_rare_words_score_above_common_ones(spark):
    rows = [(str(i), f"common word{i % 5} extra{i}") for i in range(30)]
    s = {(r["record_id"], r["term"]): r["score"] for r in D.term_scores(spark.createDataFrame(rows, "id string, t string"), "id", "t").collect()}
    assert s["0", "extra0"] > s["0", "word0"] > s["0", "common"]


def best(spark, rows):
    scores = D.term_scores(spark.createDataFrame(rows, "id string, t string"), "id", "t", presence=True)
    return {(r["record_id"], r["term"]) for r in D.most_distinctive(scores).collect()}


def fewest(rows, most=6):
    sets = {i: set(t.split()) for i, t in rows}
    df = Counter(t for s in sets.values() for t in s)
    out = set()
    for i, s in sets.items():
        low = min((df[t] for t in s if df[t] >= 2), default=99)
        out |= {(i, t) for t in s if df[t] == low and low <= most}
    return out


def test_most_distinctive_keeps_ties(spark):
    rows = [("1", "alpha beta gamma"), ("2", "alpha beta"), ("3", "gamma delta"), ("4", "delta unique")]
    assert best(spark, rows) == fewest(rows) and len(fewest(rows)) == 8
    assert best(spark, [(str(i), "shared") for i in range(7)]) == set()


def test_most_distinctive_are_the_terms_of_the_fewest_records(spark):
    rows = [(f"r{i}", " ".join(f"w{k}x" for k in range(2, 40) if i % k == 0) + f" all{'  all' * (i % 3)} own{i}") for i in range(150)]
    assert best(spark, rows) == fewest(rows)


def test_the_score_decides(spark):
    rows = [(f"r{i}", f"all{i % 2} some{i % 30} few{i % 50}") for i in range(150)]
    scores = D.term_scores(spark.createDataFrame(rows, "id string, t string"), "id", "t", presence=True)
    right = {(r["record_id"], r["term"]) for r in D.most_distinctive(scores).collect()}
    flat = {(r["record_id"], r["term"]) for r in D.most_distinctive(scores.withColumn("score", F.lit(99.0))).collect()}
    assert {t[:3] for _, t in right} == {"few"} and right < flat


def test_empty(spark):
    assert D.term_scores(spark.createDataFrame([], "id string, t string"), "id", "t").count() == 0
