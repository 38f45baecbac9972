import pytest
from pyspark.sql import types as T

from sojourn.llm import common

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns that operators use as names of their own.
        T.StructField("kept", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)
#: Running text without repetitions.
PROSE = "the quick fox and {} others " + " ".join(f"pass{a}{b}" for a in "abcdefgh" for b in "klmnopqr")


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 9973} of" for i in range(60_000)) + " a.b+c@mail.example.org " + "7" * 5000
    rows = [
        (1, PROSE.format("many"), "en", "a", 10),
        (2, PROSE.format("many"), "en", "a", 10),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", None, None, 4),
        (6, long, "en", "a", len(long)),
        (7, "mail me: jane.doe@example.com, call +1 (974) 555-3436", "en", "b", 53),
        (7, "mail me: jane.doe@example.com, call +1 (974) 555-3436", "en", "b", 53),
        (None, PROSE.format("some"), "en", "b", 3),
        (8, "é ß 日本 \u0001 x\u0002 \U0001f600 2001 Licensed under CC BY-NC 4.0.", "fr", None, 7),
        (9, "Der Hund und die Katze", "de", "c", 22),
    ]
    return [(*r, "x", None, "y", None, "z", "w") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return common.stage(spark.createDataFrame(odd_rows(), SCHEMA), "odd")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark):
    return "/root/testdata/sf0.001"
