import pytest

from cellmend.llm.common import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(spark):
    return importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes ``documents`` from (doc_id, text) or (doc_id, text, source), with
    columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, 1, "x", 2) for r in rows]
        return spark.createDataFrame(full, DOCS + ", n int, tokens string, bucket int")
    return make
