import pytest

from tallyspark.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text); a column of a name that operators use inside comes along."""
    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'x' AS n", "1 AS key", "'y' AS digest", "2L AS rep", "'z' AS ids", "0.5D AS score")
    return make
