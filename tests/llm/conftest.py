import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents from (doc_id, text[, lang[, source]]); n_chars follows."""
        full = [(*r, *([None] * (4 - len(r))), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (None, "some words here for you all", "en", "b"), (None, None, None, None), (7, long, "en", "a"), (8, "same text in two rows of five", "en", "b"), (8, "same text in two rows of five", "en", "b"), (9, "one", "fr", None), (9, "two other words", "fr", "b"), (10, "ünïcödé 文字 слова λέξεις", None, "c")]
    return make_docs(rows)


@pytest.fixture(scope="session")
def clashing():
    """Adds columns named like those that operators make inside."""
    from pyspark.sql import functions as F

    def add(df):
        names = ["id", "row", "key", "sid", "size", "twin", "copy", "order", "bucket", "kind", "norm", "spans", "score", "rank", "packer", "n", "u", "v", "h", "g", "label2", "e", "_found", "value"]
        return df.select("*", *[F.lit(f"x{n}").alias(n) for n in names if n not in df.columns])

    return add
