import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, id string, raw string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, extra columns
    whose names the operators use inside."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "a"), (2, "the CAT sat on the mat and looked at the dog.", "en", "a"), (3, None, "en", None), (4, "", None, "a"), (None, "A text without an id at all here", "fr", "a"),
        (5, "word " * 30000, "en", "b"), (6, "Der Hund und die Katze sind müde", "de", "b"), (6, "Der Hund und die Katze sind müde", "de", "b"), (7, "\n\t ", "de", "b"), (8, "12345 !!! ???", "en", "b"), (9, "ça été déjà vu 日本語 😀", None, "b"),
    ]
    return spark.createDataFrame([(*r, None, "x", "y", "z", "w") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (6, None, None), (99, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
