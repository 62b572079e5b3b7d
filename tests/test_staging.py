"""Where intermediate tables go."""

import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources.staging import TIDY, shared_dir, stage, unstage


class Session:
    def __init__(self, master, named=None, given=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: given})()


def test_shared_folder_is_named():
    assert shared_dir(Session("spark://host:1", "s3a://b/tmp/")) == "s3a://b/tmp"
    assert shared_dir(Session("yarn", None, "hdfs:///c")) == "hdfs:///c"


@pytest.mark.parametrize("master", ["yarn", "spark://host:1", "local-cluster[2,1,1024]"])
def test_a_cluster_without_one_is_an_error(master):
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_dir(Session(master))


def test_a_local_session_has_its_own():
    assert shared_dir(Session("local[4]")) == shared_dir(Session("local"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_behind(spark):
    before, setting = shuffle_files(spark), spark.conf.get(TIDY)
    grouped = spark.range(5000).groupBy((F.col("id") % 70).alias("k")).count()
    table = stage(grouped.join(spark.range(70).withColumnRenamed("id", "k").repartition(3, "k"), "k"), "tidy")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert table.count() == 70 and spark.conf.get(TIDY) == setting


def test_only_staged_tables_are_deleted(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/own")
    own, staged, other = spark.read.parquet(f"{tmp_path}/own"), stage(spark.range(7), "gone"), stage(spark.range(9), "stays")
    [folder] = {os.path.dirname(f.removeprefix("file://")) for f in staged.inputFiles()}
    unstage(own, staged, own, staged)
    assert not os.path.exists(folder) and own.count() == 5 and other.count() == 9
