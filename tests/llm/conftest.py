import pytest

from tallyrec.llm.queries import workers_find_package


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_find_package(spark)


@pytest.fixture()
def documents(spark):
    """(rows, schema) -> documents with columns whose names clash with results."""

    def make(rows, schema="doc_id bigint, text string"):
        clash = ["n", "score", "ids", "key", "row", "label"]
        df = spark.createDataFrame(rows, schema).repartition(3)
        return df.selectExpr("*", *(f"'x' as {c}" for c in clash if c not in df.columns))

    return make
