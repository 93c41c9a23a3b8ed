import pytest

from pyspark.sql import types as T

#: Columns of documents, and others whose names the operators also use.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("_text", T.StringType()), T.StructField("n_words", T.StringType()),
])

LONG = " ".join(f"word{i % 997} Größe{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def edge_rows():
    prose = "The first line of a longer passage that comes again.\nA second line, also long enough to count here.\n"
    texts = [None, "", " \n\t ", "one", "two words", "three words here", "Three WORDS here", "ÉÀ ß ñ 漢字 кириллица",
             prose * 3, prose * 3, prose + "tail", "a " * 400, "12 34 -- !!", LONG, LONG + " x", "a\x00b c\x0bd\x0ce\rf",
             "\n\n\nalpha beta gamma\n\nalpha beta gamma\n"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None, "x", "y", None, "z", "w") for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, prose * 3, None, None, None, None, None, None, None, None),
                   (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return documents.orderBy("doc_id").collect()
