import pytest

EDGE_TEXTS = [None, "", " \n\t ", "one", "One two  three\nfour"]


@pytest.fixture(scope="session")
def docs_table(spark):
    """rows -> documents with the given (doc_id, text) and further columns whose names clash."""
    def make(rows, parts=3):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, row string, found long, "
                  "bin int, score string, h long, text_key int, lines string")
        return spark.createDataFrame(
            [(i, t, None, "s", None if t is None else len(t), "r", 1, 2, "x", 3, 4, "l") for i, t in rows],
            schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def rows_of():
    """Rows as sorted tuples, nulls first."""
    def get(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, x) for x in t])
    return get
