import pytest

ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id int, n int, s string, host string, `key` int, spans_ string, score_ string, n_lines_ int, blob_ int, `a.b` int"
)


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, one very long text, clashing column names."""
    extra = (1, 2, "x", "h", 4, "sp", "sc", 5, 6, 7)
    none = (None,) * 10
    long_text = " ".join(f"w{i % 977}q{i}" for i in range(30_000))
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    return [
        (1, words, "en", "a", 10, *extra),
        (2, None, None, None, None, *none),
        (3, "", "en", "a", 0, *extra),
        (4, " \t\n\r\x0b\x0c ", "en", "a", 7, *extra),
        (5, words.upper(), "en", "b", 10, *extra),
        (6, "one two", "de", None, 7, *extra),
        (7, "Two ONE", "de", "b", 7, *extra),
        (8, "ONE two", "de", "b", 7, *extra),
        (9, long_text, "en", "a", len(long_text), *extra),
        (10, long_text + " tail", "en", "a", 1, *extra),
        (11, "naïve café — ǆ ﬁ ́x <|endoftext|> 中文 text \x1c\x85\xa0 end", "fr", "c", 1, *extra),
        (11, "naïve café — ǆ ﬁ ́x <|endoftext|> 中文 text \x1c\x85\xa0 end", "fr", "c", 1, *extra),
        (None, words, "en", "a", 10, *extra),
        (None, None, None, None, None, *none),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3, "lang").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
