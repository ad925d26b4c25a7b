import pytest
from pyspark.sql import functions as F

from refloom.functions import bibliographic as B


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_doi(spark):
    bare = "10.5555/ab(12)c-7"
    assert values(spark, B.doi, [bare.upper(), f"DOI {bare};", f"cf. https://doi.org/{bare}.", f"<{bare}>"]) == [bare] * 4
    assert values(spark, B.doi, ["10.55/short", "no identifier", "20.5555/x", "", None]) == [None] * 5


def test_isbn(spark):
    # 9 digits and a check digit, and the same with its prefix
    assert values(spark, B.isbn13, ["3-540-65995-9", "978 3 540 65995 9"]) == [None, None]
    assert values(spark, B.isbn13, ["0306406152", "978-0-306-40615-7", "9780306406157"]) == ["9780306406157"] * 3
    assert values(spark, B.isbn13, ["080442957X", "0804429570", "97803064061577", "", None]) == ["9780804429573", None, None, None, None]


def test_names(spark):
    assert values(spark, B.surname, ["Mira Holt", "Holt, Mira", "M. K. Holt", "de la Cruz, Ines", None]) == ["Holt", "Holt", "Holt", "de la Cruz", None]
    assert len(set(values(spark, B.author_key, ["Mira Holt", "M. Holt", "Holt, M."]))) == 1
    assert len(set(values(spark, B.author_key, ["Jörg Würth", "Wurth, J."]))) == 1
    assert len(set(values(spark, B.author_key, ["Mira Holt", "Nora Holt", "Mira Holte"]))) == 3


def test_match_key_and_ids(spark):
    assert values(spark, B.match_key, ["  Çédille — & Ångström ", None, "ﬂow ¾"]) == ["cedille angstrom", None, "flow 3 4"]
    a, b = values(spark, B.local_id, ["On  Trees", "on trees."])
    assert a == b and a.startswith("local:")


def test_seed_groups(spark):
    assert values(spark, B.seed_group, ["Q7", "qa.1", "7Q", None]) == ["Q", "QA", None, None]
    assert values(spark, lambda c: B.seed_group(c, r"^\d+-([A-Za-z]+)"), ["12-xy3"]) == ["XY"]


def test_parsed_reference(spark):
    raw = "[12] M. K. Holt and Cruz, I. On small trees and their covers. Rec. Trees 4(3): 10-29, 1987. ISBN 978-0-306-40615-7 https://x.example/a. doi:10.5555/t.9"
    r = values(spark, B.parsed_reference, [raw, "Holt, M. “A title that stands in quotes,” 2003", "see above", None, "N. Ode. Notes on counting again. ISBN 978-0-306-40615-8"])
    assert (r[0]["doi"], r[0]["year"], r[0]["volume"], r[0]["issue"], r[0]["pages"]) == ("10.5555/t.9", 1987, "4", "3", "10-29")
    assert r[0]["authors"] == ["M. K. Holt", "Cruz, I."] and r[0]["isbn"] == "9780306406157" and r[0]["warnings"] == []
    assert r[0]["title"] == "On small trees and their covers" and r[1]["title"] == "A title that stands in quotes" and r[1]["authors"] == ["Holt, M."]
    assert r[2]["title"] is None and r[2]["year"] is None and r[2]["warnings"] == ["no-title"]
    assert r[4]["isbn"] is None and "isbn-checksum" in r[4]["warnings"]


def test_reference_authors(spark):
    lists = ["A. Bee, C. Dee and E. F. Gee. Title", "Bee, A., Dee, C. & Gee, E. F. Title", "Title first. A. Bee", "1. A. Bee; C. Dee: Title", "", None]
    assert values(spark, B.reference_authors, lists) == [["A. Bee", "C. Dee", "E. F. Gee"], ["Bee, A.", "Dee, C.", "Gee, E. F."], [], ["A. Bee", "C. Dee"], [], None]
    many = " and ".join(f"A. Name{i}x" for i in range(500))
    assert len(values(spark, B.reference_authors, [many])[0]) == 500


@pytest.mark.parametrize(("value", "want"), [("../up", None), ("..", None), ("", None), ("one two", "one-two"), ("-x.1-", "x.1"), ("k:v/w", None), ("a" * 200, "a" * 120)])
def test_safe_segment(spark, value, want):
    assert values(spark, B.safe_segment, [value]) == [want]


def test_scores_and_urls(spark):
    df = spark.createDataFrame([("Small trees", "Small trees", 1987, 1987), ("Small trees", "Small trees", 1987, 1999), ("Small trees", "Large rings", 1987, 1987)], "a string, b string, y int, z int")
    s = [r[0] for r in df.select(B.match_score(F.col("a"), F.col("b"), F.col("y"), F.col("z"), F.lit(True))).collect()]
    assert 0.9 < s[0] <= 0.99 and s[1] < s[0] - 0.2 and s[2] < 0.4
    assert values(spark, B.url_path, ["http://y.example/b/../c/./d?x#z"]) == ["/c/d"] and values(spark, B.host, ["http://Y.example:8080/b"]) == ["y.example"]
