import pytest


@pytest.fixture
def docs_of(spark):
    """A documents-like table of (doc_id, text) pairs with extra columns whose
    names clash with those the operators make."""
    def make(rows, partitions=3):
        full = [(i, t, "x", i, "y", "z") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, kept string, n_tokens long, score string, _text string").repartition(partitions)
    return make
