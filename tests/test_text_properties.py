"""Property tests: the native text rules equal their plain-Python statements
on random Unicode strings (one Spark job per batch)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from railtrace.functions import text as T
from tests.test_text import folded


TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)
WORDS = st.lists(st.sampled_from(["bf", "hbf", "gare", "bad", "de", "la", "paris", "2nd", "nord", "a1b", "x"]), max_size=6).map(" ".join)


def shown(words):
    """The display form of plain words: fillers go, small words keep their case, others are capitalized."""
    return " ".join(SHOWN[w] for w in words.split() if w in SHOWN)


# input word -> display word, for the words drawn here; fillers have none
SHOWN = {"de": "de", "la": "la", "paris": "Paris", "2nd": "2nd", "nord": "Nord", "a1b": "A1b", "x": "X"}


@settings(max_examples=3, deadline=None)
@given(st.lists(TEXT, min_size=50, max_size=200))
def test_normalize_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r.n for r in df.select("i", T.normalize_text("s").alias("n")).orderBy("i").collect()]
    assert got == [folded(v) for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(WORDS, min_size=20, max_size=100))
def test_simplify_and_title_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", T.simplify_station("s").alias("a"), T.title_case_station("s").alias("b")).orderBy("i").collect()
    assert [r.a for r in rows] == [shown(v) for v in values]
    assert [r.b for r in rows] == [(v or "").strip().title() for v in values]
