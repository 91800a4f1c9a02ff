import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


#: Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns with names the operators use.
ODD_ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", None, "a"), (4, "one", None, "a"),
    (None, "one two three four", "en", None), (None, "one two three four", "en", None), (5, "x" * 30000, "de", "b"),
    (6, "a b c d e f g h i j k l m n o p q r s t u v " * 400, "de", "b"), (7, "A b\nc", "fr", "b"), (8, "Ab c", "fr", "c"),
    (9, "é ü 東京 😀\x0b<|endoftext|> it's  done", "es", "c"), (10, "nul\x00 byte", "en", "c"), (11, "", None, "c"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    for name in ("shard", "slot", "fp", "n", "size", "copies", "kept", "row", "score", "root", "key", "rank", "bin", "target"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
