import pytest
from words import WORDS, passage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, spans string, label double"

@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(WORDS * 40)
    rows = [
        (1, passage(0), "en", "a", 1, 1, "x", 0.0),
        (2, passage(0), "en", "a", 1, 1, "x", 0.0),
        (3, passage(0) + " extra words", None, None, None, None, None, None),
        (4, None, "de", "a", 1, 1, "x", 0.0),
        (5, None, "de", "a", 1, 1, "x", 0.0),
        (6, "", "de", "a", 1, 1, "x", 0.0),
        (7, long, "fr", "a", 1, 1, "x", 0.0),
        (7, long, "fr", "a", 1, 1, "x", 0.0),
        (8, "one two", "fr", "a", 1, 1, "x", 0.0),
        (9, "!!! ...", "fr", "a", 1, 1, "x", 0.0),
        (10, passage(200, 80), "en", "a", 1, 1, "x", 0.0),
        (11, "start " + passage(200, 80), "en", "a", 1, 1, "x", 0.0),
        (12, "caf\u00e9 \u00fcber \U0001f600 na\u00efve " * 9, "fr", "a", 1, 1, "x", 0.0),
        (None, passage(300, 30), "en", "a", 1, 1, "x", 0.0),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
