import pytest

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HOSTILE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "", "", 4),
    (None, "A text without an id that is long enough to be a text of its own kind.", "en", "a", 60),
    (5, "tie tie tie tie tie tie tie tie tie", "en", "b", 35),
    (6, "tie tie tie tie tie tie tie tie tie", "en", "b", 35),
    (7, "same row twice over and over again", "en", "b", 34),
    (7, "same row twice over and over again", "en", "b", 34),
    (8, "long " * 30_000, "en", "b", 150_000),
    (9, "naïve ñandú été — 😀 日本語\r\nsecond line", "fr", "c", 30),
]


@pytest.fixture
def hostile(spark):
    """Documents with nulls, empty, very long and repeated texts, ties, and
    extra columns whose names helpers might use."""
    df = spark.createDataFrame(HOSTILE, DOCS)
    return df.select("*", *[F.lit(1).alias(c) for c in (
        "k", "row", "block", "p", "line", "id", "shard", "word count", "key", "doc", "gone", "left", "n", "language", "_1",
        "a.b")])


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCS)

