"""Settings of the session."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from quadrille import session


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def test_shuffles_of_a_written_table_go_with_its_job(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(key, None)
    pairs = spark.range(20000).groupBy((F.col("id") % 1000).alias("k")).agg(F.max("id").alias("m"))
    joined = pairs.join(spark.range(1000).withColumnRenamed("id", "k").hint("merge"), "k")
    kept = session.stage(joined, "kept")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.agg(F.count("*"), F.sum("m")).first()[:] == (1000, sum(range(19000, 20000)))
    assert spark.conf.get(key, None) == setting


def test_setting_of_shuffles_comes_back_after_an_error(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    with pytest.raises(ValueError), session.dropped_shuffles(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key, None) == setting


def test_tasks_are_bounded_and_finer_settings_stay(spark):
    advisory, files = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k, None) for k in (advisory, files)}
    try:
        spark.conf.set(advisory, "64MB")
        spark.conf.set(files, "8m")
        session.bound_tasks(spark)
        assert spark.conf.get(advisory) == str(session.TASK_BYTES)
        assert spark.conf.get(files) == "8m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
