import pytest

from demandlab.llm.queries import importable


@pytest.fixture(scope="session", autouse=True)
def package_in_tasks(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(*rows):
        rows = [(doc_id, text, None, "src", 7.0, "x") for doc_id, text in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, findings string")

    return make
