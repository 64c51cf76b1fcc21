import unicodedata

import pytest
from pyspark.sql import functions as F

from railtrace.functions import text as T


def one(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.x for r in df.select("i", fn(F.col("s")).alias("x")).orderBy("i").collect()]


NORMALIZE = [
    ("Zürich HB", "zurich hb"), ("København", "kbenhavn"), ("Gießen", "gieen"), ("Łódź", "odz"),
    ("Köln–Bonn", "kolnbonn"), ("L'Aquila", "l aquila"), ("L’Aquila", "laquila"), ("София", ""),
    ("   ", ""), (None, ""), ("a½b", "a12b"), ("ﬁnal  ĳssel", "final ijssel"), ("\tParis-Nord\n", "paris nord"),
    ("Ǆ℃x", "dz x"),
]


def test_normalize_fixtures(spark):
    assert one(spark, T.normalize_text, [a for a, _ in NORMALIZE]) == [b for _, b in NORMALIZE]


def fold(ch):
    """What one character leaves: its lower-case ASCII letters and digits, or gaps (a
    capital that only appears in folding, as in the numero sign, is one)."""
    kept = [c for c in unicodedata.normalize("NFKD", ch.lower()) if c.isascii()]
    return "".join(c if c.islower() or c.isdigit() else " " for c in kept)


def folded(text):
    return " ".join("".join(map(fold, text or "")).split())


def test_normalize_folds_every_character(spark):
    """Every code point up to the last that folds to ASCII, in context."""
    chars = [chr(c) for c in range(0x20, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    values = [f"A{ch}b {ch}" for ch in chars]
    got = one(spark, T.normalize_text, values)
    assert [(hex(ord(ch)), g) for ch, v, g in zip(chars, values, got) if g != folded(v)] == []


def test_normalize_expansions(spark):
    values = ["Gleis № 5", "Halt ⑩", "℀x", "A⑩b", "🄁x"]
    assert one(spark, T.normalize_text, values) == ["gleis o 5", "halt 10", "a cx", "a10b", "0 x"]


SIMPLIFY = [
    ("koln hbf", "Koln"), ("paris gare du nord", "Paris du Nord"), ("bad ragaz", "Ragaz"),
    ("la rochelle ville", "la Rochelle Ville"), ("hbf", ""), ("2nd x", "2nd X"), ("", ""), (None, ""),
    ("gare de lyon", "de Lyon"), ("badenweiler hbfx", "Badenweiler Hbfx"),
]


def test_simplify_fixtures(spark):
    assert one(spark, T.simplify_station, [a for a, _ in SIMPLIFY]) == [b for _, b in SIMPLIFY]


TITLE = [("halle 2b", "Halle 2B"), ("2nd x", "2Nd X"), ("a1b2c3", "A1B2C3"), (None, ""), ("", ""),
         ("  zurich hb ", "Zurich Hb"), ("ABC def", "Abc Def")]


def test_title_fixtures(spark):
    assert one(spark, T.title_case_station, [a for a, _ in TITLE]) == [b for _, b in TITLE]
    assert [b for _, b in TITLE] == [(a or "").strip().title() for a, _ in TITLE]


def test_strip_stars_and_numbers(spark):
    assert one(spark, T.strip_stars, [" Plane* ", "*", None, "Night Train **"]) == ["Plane", "", None, "Night Train"]
    got = one(spark, T.to_number, ["12.5", " 7 ", "n/a", "1,5", "", "1e3", "1.0d", "-3", ".5", None])
    assert got == [12.5, 7.0, None, None, None, 1000.0, None, -3.0, 0.5, None]


@pytest.mark.parametrize("fn", [T.normalize_text, T.simplify_station, T.title_case_station])
def test_no_python_in_plan(spark, fn):
    df = spark.createDataFrame([("x",)], "s string").select(fn("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
