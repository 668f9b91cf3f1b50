import pytest

from small_corpus import edge_rows

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, _text string, n int, h int, "
          "slot string, fp string, row string, tail string")
@pytest.fixture(scope="session")
def edge(spark):
    rows = [(d, t, lang, "s", None if t is None else len(t), "x", "y", 1, 2, "z", "f", "r", "t") for d, t, lang in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
