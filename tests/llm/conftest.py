import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("slot", T.IntegerType()),
    T.StructField("spans", T.StringType()), T.StructField("taken", T.StringType()),
])


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names also occur inside the operators."""

    def make(rows):
        full = [(i, t, "en", s, len(t or ""), 1, "x", "y") for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, a tie, a repeated row, a long text."""
    words = " ".join(f"w{i}" for i in range(60))
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, words, "a"), (5, words, "b"), (6, words + " end", "b"),
        (6, words + " end", "b"), (7, "one two", "b"), (8, "one  two", "c"), (None, words, "c"),
        (9, "long " * 4000 + words, "a"), (10, "ünï çödé 你好 ▁ \x00 " + words, "c"),
    ]
