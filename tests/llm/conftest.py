import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text) or longer rows."""

    def make(rows, schema=DOC):
        filled = [tuple(r) + ("en", "a", len(r[1] or ""))[len(r) - 2 :] for r in rows]
        return spark.createDataFrame(filled, schema)

    return make
