import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _kept string, ids int"
LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, blanks, very long texts, repeated rows, and columns that clash with results."""
    clean = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix new potions for twenty guests tonight"
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, LONG, "en"), (5, "x" * 70_000, None), (6, clean, "en"),
        (6, clean, "en"), (7, clean, "en"), (None, clean + " again", "en"), (9, "1234 5678 !!! ???", "en"), (10, "é" * 50, "fr"),
    ]
    return spark.createDataFrame([(i, t, lang, None, len(t or ""), 0.5, "k", 3) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", F.col("text")).collect()}
