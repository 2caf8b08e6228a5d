from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def table(spark):
    """Rows and a DDL schema to a DataFrame in several partitions."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
