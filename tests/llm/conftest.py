import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("length", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text, lang, source), with a column whose name clashes."""
    def make(rows):
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), "x") for i, t, g, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls everywhere, empty, blank, very long, tied and repeated rows."""
    long = " ".join(f"wort{k % 977}" for k in range(30_000))
    rows = [(1, "the cat and the dog", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "de", "b"), (None, "the cat and the dog", None, "a"),
            (5, long, "de", "b"), (6, "the cat and the dog", "en", "a"), (6, "the cat and the dog", "en", "a"), (7, "a  b \n c", "en", ""), (None, None, None, None)]
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
