import pytest
from pyspark.sql import types as T

#: Nulls, empty texts, white space only, ties, repeated rows, a long text, no letters, bytes outside ASCII.
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "en", None),
    (5, "alpha BETA gamma delta epsilon zeta eta theta", "en", "a"), (5, "alpha BETA gamma delta epsilon zeta eta theta", "en", "a"),
    (None, "alpha beta gamma delta epsilon zeta eta theta", "en", "b"), (None, None, None, None), (7, "1234 5678 !!", "en", "b"),
    (8, "één twee drie ÄÖÜ 日本語 🙂", "nl", "c"), (9, "word " * 30_000, "en", "c"), (10, "two words", "en", "b"), (11, "Two WORDS", "en", "b"),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    *[T.StructField(c, T.IntegerType()) for c in ("digest", "row", "p", "passed", "keep_id", "class", "gram", "component", "n", "size", "ids", "slice",
                                                       "u", "rate", "train", "batch", "word", "share", "bucket", "round", "learner", "mark", "drop", "line")]])


def table(spark, rows):
    """Documents with more columns, of names that the operators use themselves."""
    return spark.createDataFrame([(*r, *([0] * 24)) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
