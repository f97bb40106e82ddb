import pytest
from pyspark.sql import types as T

#: Rows that every operator must survive: nulls, empty and blank texts, repeats, ties, a long text,
#: one word without an end, and columns whose names the operators use themselves.
LONG = "lorem ipsum dolor sit amet 4111 1111 1111 1111 " * 4000
HARD = [
    (1, None, "en", "a", None, 5), (2, "", None, "b", 0, 5), (3, " \t\n\x0b\x0c\r ", "de", None, 7, 5),
    (4, "one two three four five six seven", "en", "a", 33, 5), (4, "one two three four five six seven", "en", "a", 33, 5),
    (5, "one two three four five six seven", "en", "a", 33, 5), (6, LONG, "en", "a", len(LONG), None),
    (7, "x" * 60_000, "fr", "c", 60_000, 1), (8, "Ünï cödé — ｆｕｌｌ 漢字 ▁ \U0001f600 é", "fr", "c", 1, 1),
    (9, "0 1 2 3 4 5 6 7 8 9 " * 3000, None, "c", 1, 1),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_words", T.IntegerType()),
    T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType()), T.StructField("h", T.StringType()),
    T.StructField("length", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("item", T.StringType()), T.StructField("key", T.StringType()),
])


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame([(*r, "p", "q", "r", "s", "t", "u", "v", "w") for r in HARD], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
