"""Every registered query against its SQL at the smallest scale."""

import os
import subprocess
import sys

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from pairmill.plans.catalog import QUERIES
from pairmill.plans.oracle import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert difference(contract.queries()[name](spark, SF), tables, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 80


def test_workers_need_no_package(tmp_path):
    """From another folder, with the package on the driver's path only."""
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.abspath(contract.__file__)!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("stream_job_completion", "seqfile_pairs"):
    assert entry.queries()[name](spark, {SF!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
