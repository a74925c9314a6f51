import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text, lang, source) rows as a table, with extra columns whose names clash with results."""

    def make(rows, schema="doc_id long, text string, lang string, source string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema)
        clash = ["n", "score", "size", "secrets", "items", "hits", "kept", "component", "base", "extra", "rank", "part", "block", "key", "n_words", "signature", "offset", "label", "n_tokens"]
        return df.withColumns({c: F.lit("clash") for c in clash}).withColumn("n_chars", F.length("text").cast("long"))

    return make


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, "one", "en", None), (5, "12345 !!", "en", "b"), (None, "null id here", "en", "b"), (6, "twice the same row", "en", "b"), (6, "twice the same row", "en", "b"), (7, "x" * 50_000, "en", "a"), (8, "word " * 30_000, "en", "c"), (9, "ünï ßtraße 中文 😀 text", "de", "ü")]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
