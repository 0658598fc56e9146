import pytest
from pyspark.sql import functions as F

from stargauge.llm.store import ship_package

#: doc_id, text, lang, source: nulls, empty and white texts, ties, repeated rows, odd characters, one very long word.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a/b"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a/b"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a/b"),
    (3, None, "en", "a/b"), (4, "", None, None), (5, " \t\n\x0b\x0c\r ", "de", "c"), (6, "1234 ... !!!", "de", "c"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund am Fluss heute", "de", None),
    (None, "Der schnelle braune Fuchs springt über den faulen Hund am Fluss morgen", "de", "c"),
    (None, None, None, None), (8, "x" * 50_000, "en", "a/b"), (9, "a " * 30_000, "en", "a/b"),
    (10, "Été À L'École 😀   ſß İ <|endoftext|> <|ENDOFTEXT|>", None, "\U0001F600"),
    (11, "one two", "en", "z"), (12, "ONE two\n\nONE two\none  two", "en", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names operators use themselves."""
    ship_package(spark)
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").repartition(3)
    for name in ("size", "score", "rank", "version", "cid", "block", "n", "at", "words", "row", "shard", "lang_pred", "kind", "node", "draws"):
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    ship_package(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
