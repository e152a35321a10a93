import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """``(doc_id, text[, source])`` rows as a documents table with columns that clash with inner names."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions).selectExpr("*", "1 key", "2 size", "'x' _source", "3 id")

    return make
