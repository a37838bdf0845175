import pytest

from ordermill.llm.store import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with inner names."""
    ship(spark)

    def make(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA + ", part bigint, `row` string").repartition(3)

    return make
