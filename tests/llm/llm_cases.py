"""Inputs that the tests of the corpus operators share."""

import duckdb
import pytest

from conftest import SF_DIR

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the small documents, by id."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa "
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "   \n\t ", "en", "s", 6),
        (4, "word", "en", "s", 4),
        (5, word * 3000, "en", "s", 1),
        (5, word * 3000, "en", "s", 1),
        (6, "漢字 kana 😀 é " * 40, None, "s", 1),
        (None, "a row without an id", "en", None, 3),
        (None, None, None, None, None),
        (-7, word * 30, "en", "s", 2),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clash = ("words", "ids", "score", "f", "row", "h", "class", "rep", "place", "found", "label")
    return df.selectExpr("*", *(f"'x' AS {c}" for c in clash))


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
