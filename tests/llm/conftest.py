import pytest


@pytest.fixture(scope="session")
def table(spark):
    """A documents table of given texts, with ids from 0 and columns whose names operators use inside."""
    def make(texts, start=0):
        rows = [(start + i, t, "en" if i % 2 else None, "src", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make
