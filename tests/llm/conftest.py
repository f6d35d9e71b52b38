import pytest

from moodindex.llm.common import prepare


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(rows, schema=DOC_SCHEMA):
        rows = [r if len(r) == 5 else (r[0], r[1], "en", "s0", None) for r in rows]
        return spark.createDataFrame(rows, schema)
    return make
