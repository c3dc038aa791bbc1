import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A table of one partition or more from rows and a schema text."""
    def make(rows, schema, parts=3):
        df = spark.createDataFrame(rows, schema)
        return df.repartition(parts) if rows else df
    return make


@pytest.fixture(scope="session")
def documents(frame):
    """Documents as in production, with a column that clashes with names inside the operators."""
    def make(texts, langs=None, sources=None, ids=None):
        n = len(texts)
        langs, sources, ids = langs or ["en"] * n, sources or [f"src{i % 7}" for i in range(n)], ids if ids is not None else list(range(n))
        rows = [(i, t, a, s, None if t is None else len(t), "x", "y", 5) for i, t, a, s in zip(ids, texts, langs, sources)]
        return frame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, row string, n long")
    return make
