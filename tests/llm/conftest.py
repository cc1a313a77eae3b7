import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = "word " * 3000 + "ünïcode " * 500
    rows = [
        (1, "plain text of a few words here", "en", "a", 30, "x", "y"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", "y"),
        (None, "no id at all but with some words", "en", None, 5, None, None),
        (4, "plain text of a few words here", "en", "a", 30, "x", "y"),
        (4, "plain text of a few words here", "en", "a", 30, "x", "y"),
        (5, long_text, "de", "b", len(long_text), "x", "y"),
        (6, "   \n\t\n  ", "en", "b", 9, "x", "y"),
        (7, "a", "en", "b", 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
