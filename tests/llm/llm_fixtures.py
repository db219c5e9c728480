import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, in the table's columns."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
