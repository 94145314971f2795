import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: A text of distinct words, so that nothing in it repeats.
LONG = " ".join(f"word{i}x{i * i % 97}" for i in range(400))
#: Missing values in every column, empty and very long texts, repeated rows, clashing columns.
ROWS = [
    (1, LONG, "en", "a", 10),
    (2, LONG, None, None, None),
    (2, LONG, None, None, None),
    (3, None, "en", "a", 1),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4),
    (6, "one two", "en", "c", 7),
    (None, LONG + " tail", "en", "a", 3),
    (None, None, None, None, None),
    (7, ("alpha beta gamma " * 30_000), "en", "d", 5),
    (8, "Été 🙂 x\x00y " + LONG[:1500] + " äöü # * $ | <a> 100%", "fr", "a", 8),
    (9, "ab" * 300_000, "en", "b", 9),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing(docs):
    """Columns named like what the operators add or use inside."""
    names = ["id", "key", "size", "fp", "name", "place", "spans", "places", "n_words", "fail_bits", "host", "target", "copies", "component_id", "item", "h", "n"]
    for name in names:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture
def sf_dir(spark, tmp_path):
    """A folder with tables from literal rows."""

    def write(**tables):
        for name, df in tables.items():
            df.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
