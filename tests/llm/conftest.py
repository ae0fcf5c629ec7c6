import pytest
from pyspark.sql import types as T

TEXTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                      T.StructField("size", T.StringType()), T.StructField("cell", T.StringType())])


@pytest.fixture
def docs(spark):
    """Rows (id, text) as documents, with columns whose names clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], TEXTS)
    return make


EDGES = [(1, None), (2, ""), (3, "   \n\t "), (4, "Hello, world. Hello"), (4, "Hello, world. Hello"), (None, "no id at all"),
         (5, "x" * 3000 + " " + "word " * 9000), (6, "naïve café <|endoftext|> don't 12\r\n")]
