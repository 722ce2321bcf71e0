"""Durable tables, the shared folder and sizing."""

import pytest

from pairmill import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {"spark.checkpoint.dir": named}


def test_named_folder_is_used():
    assert session.shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(Session("yarn", None, "hdfs:///set")) == "hdfs:///set"


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError):
        session.shared_dir(Session("spark://host:7077"))


def test_a_local_master_gets_a_folder_once():
    local = Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_durable_cuts_the_plan(spark):
    table = session.durable(spark.range(10).selectExpr("id % 3 AS k", "id"), "test")
    assert table.count() == 10
    assert "Range" not in table._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_there_are_too_few_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(0, 100, 1, 1)
    assert session.spread(few, "id").rdd.getNumPartitions() == 2 * cores
    many = spark.range(0, 100, 1, cores)
    assert session.spread(many, "id") is many


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert session.size_shuffles(spark, 1) == 2 * spark.sparkContext.defaultParallelism
        assert session.size_shuffles(spark, 1 << 40) == 8192
        # A gibibyte per task at any size; a smaller input later takes nothing back.
        assert session.size_shuffles(spark, 100 << 40) == 819_200
        assert session.size_shuffles(spark, 1) == 819_200
        assert spark.conf.get("spark.sql.shuffle.partitions") == "819200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_batches_of_documents_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for held, bounded in (("10000", "1000"), ("0", "1000"), ("70", "70")):
            spark.conf.set(key, held)
            session.bound_batches(spark)
            assert spark.conf.get(key) == bounded
    finally:
        spark.conf.set(key, before)
