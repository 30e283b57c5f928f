import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def tiny():
    """The smallest size of the given tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows(spark):
    """A frame of (doc_id, text) pairs."""

    def make(pairs):
        return spark.createDataFrame([Row(doc_id=i, text=t) for i, t in pairs], "doc_id long, text string")

    return make
