from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from candlemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("candlemill-tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(params=["UTC", "Asia/Shanghai"])
def zone(request, spark):
    """Run a test under two session time zones."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def folder(spark):
    from candlemill.session import scratch_path

    return lambda label: scratch_path(spark, label)
