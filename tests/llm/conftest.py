import pytest
from llm_helpers import DOCS, ODD


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
