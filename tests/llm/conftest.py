import pytest


@pytest.fixture
def frame(spark):
    """A table of documents from (doc_id, text) pairs, with further columns of clashing names."""
    def make(rows, ids="doc_id"):
        return spark.createDataFrame(
            [(i, t, "en", "s", None, "x", 7, "y") for i, t in rows],
            f"{ids} bigint, text string, lang string, source string, n_chars bigint, fp string, cell int, words string")
    return make
