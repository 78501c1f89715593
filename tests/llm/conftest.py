import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns with names that operators might use themselves
    T.StructField("h", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("x", T.StringType()), T.StructField("rank", T.StringType())])
EXTRA = ("a", "b", "c", "d", "e", "f")
LONG = " ".join(f"word{i % 977} und der Hund," for i in range(40_000))


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text, lang, source) rows."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t), *EXTRA) for i, t, lang, src in rows],
            DOCUMENTS)
    return make


@pytest.fixture
def odd(documents):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, rare characters."""
    return documents([
        (1, None, None, None), (2, "", "de", "s1"), (3, LONG, "de", "s1"), (4, "a", "en", None),
        (5, "the MIT\nLicense, and the mit-license", "en", "s2"), (None, "no id at all", "en", "s2"),
        (None, None, None, None), (6, "same text here", "en", "s1"), (7, "same text here", "en", "s1"),
        (7, "same text here", "en", "s1"), (8, "  \t\n ", "fr", ""), (9, "12 34 !!", "fr", "s3"),
        (10, "▁ 𝒳 \u0000 é é 日本語", "ja", "s3")])


@pytest.fixture
def empty(documents):
    return documents([])
