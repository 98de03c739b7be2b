"""Shared helpers of the subpackage's tests."""

import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a schema string, spread over several partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make
