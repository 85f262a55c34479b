import glob
import os
import zipfile

import pytest
from pyspark import SparkFiles

from lakeshift.session import cluster_conf, scratch_dir, ship_package


def test_cluster_conf_sizes_shuffle_from_input():
    big = cluster_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "160000"  # capped at 20 per core
    small = cluster_conf(10**9, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # at least 2 per core
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_dir_under_checkpoint_root(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root.rstrip("/")) and a != b


def test_ship_package_once(spark):
    ship_package(spark)
    ship_package(spark)  # idempotent per application
    zips = glob.glob(os.path.join(SparkFiles.getRootDirectory(), "lakeshift.zip"))
    assert zips and "lakeshift/operators/history.py" in zipfile.ZipFile(zips[0]).namelist()


class _Remote:
    """A session on a cluster without a checkpoint folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: _Remote.conf)


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_Remote, "x")


def test_missing_response_folder_is_an_error(tmp):

    from lakeshift.sources.sliced import Slice, file_fetch

    part = Slice.__new__(Slice)
    part.name = "nowhere"
    for root in (tmp, "s3a://bucket/x"):
        with pytest.raises((FileNotFoundError, ValueError)):
            file_fetch(root, part)


def test_alerts_of_runs_without_id_are_kept(spark, tmp):
    from lakeshift.plans.cost_monitor import run_cost_monitor
    from lakeshift.plans.fixtures import cluster_samples, table
    from pyspark.sql import functions as F

    samples = cluster_samples(table(spark, "/root/testdata/sf0.001", "orders")).withColumn("run_id", F.lit(None).cast("string"))
    assert run_cost_monitor(spark, samples, f"{tmp}/log").count() > 0


def test_text_sequence_is_refused_at_entry(spark):
    from lakeshift.operators import scd2

    df = spark.createDataFrame([(1, "a", 2)], "k int, s string, v int")
    with pytest.raises(TypeError):
        scd2(df, keys=["k"], sequence_by="s", track=["v"])
