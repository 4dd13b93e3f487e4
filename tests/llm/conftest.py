import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents table from a list of texts, doc_id counting from 0."""
    def make(texts, start=0):
        rows = [(start + i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make
