import pytest

from terrazone.llm.common import let_workers_import

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) or (doc_id, text, source) tuples."""
    def make(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)
    return make
