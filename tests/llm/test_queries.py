"""The registered queries of the subpackage: against their SQL twins, and on names and nothing else."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import oracle_check
from candlemill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert oracle_check.compare(spark, oracle_check.connect(SF), name, SF, QUERIES, ORACLES) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for name in entry.queries() if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name, rows", [("op3_main_text", "pages"), ("op5_quality", "documents"), ("op9_language", "documents"), ("op10_toxicity", "documents")])
def test_one_row_for_each_row(spark, name, rows):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{rows}.parquet").count()


def test_url_filter_runs_no_python(spark):
    plan = QUERIES["op8_url_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)


OUTSIDE = """
import os, sys, tempfile
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate())
import corpus_pipeline
from candlemill.llm.queries import QUERIES
docs = spark.read.parquet({sf!r} + "/documents.parquet").limit(60)
print("rows", corpus_pipeline.near_duplicates(spark, docs, "").count())
for name in sorted(QUERIES):
    print("rows", QUERIES[name](spark, {sf!r}).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Everything runs from a folder where neither the driver's path nor the package reaches the Python workers."""
    script = tmp_path / "outside.py"
    script.write_text(OUTSIDE.format(root=oracle_check.ROOT, sf=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.stdout.count("rows") == len(QUERIES) + 1, done.stderr[-2000:]
