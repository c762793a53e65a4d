import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id with two texts."""
    long = " ".join(f"word{i % 977} of the longest text" for i in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\n ", "en", None, 5), (None, "a text without an id here", None, "b", 1),
        (4, long, "en", "a", len(long)), (5, "the same words in this row", "en", "a", 9), (5, "the same words in this row", "en", "a", 9),
        (6, "one id and the first text", "fr", "b", 3), (6, "one id and quite another text", "de", "c", 4), (7, "12345 !!", "en", "a", 8),
        (8, "É" * 300_000, None, "a", 1), (9, "\x00▁\U0010FFFF  x", "es", "a", 6), (10, "x", "", "", -1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs():
    return duckdb.sql("SELECT doc_id, text, lang, source, n_chars FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
