"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "quadrille", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the session that is there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Quads take fifteen times as much memory as they take in a shuffle or a file, so tasks get no more than this of either.
TASK_BYTES = 16 << 20


def allow_skew_splits(spark: SparkSession) -> None:
    """Let adaptive execution split a hot join key even where that costs one more shuffle."""
    for key in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{key}", "true")


def _bytes(text: str) -> int:
    """A size as Spark's settings write it, such as ``64MB``."""
    found = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", text.lower())
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found[2]]


def bound_tasks(spark: SparkSession) -> None:
    """Let no task read or merge more than ``TASK_BYTES``, so that its memory does not grow with the tables.

    Settings of the session that are finer stay as they are. A shuffle of more than 200 partitions would sort its rows in memory
    before it writes them, so their number is left alone.
    """
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        if _bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, str(TASK_BYTES))


#: Texts are held several times over on their way to Python and back.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let no batch for Python take more than about ``BATCH_BYTES``, so that its memory does not grow with the length of the
    texts. A setting of the session that is finer stays as it is."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).startswith("-") or _bytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="quadrille-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written yet."""
    return f"{shared_dir(spark)}/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let the shuffle files of each write within go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, however much disk they take. What was written is
    not read from them again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and go on from the table.

    Used where a result feeds several branches of a plan that would each compute it again. The table
    outlives the executors that wrote it, the shuffles that made it do not.
    """
    path = fresh_path(df.sparkSession, name)
    with dropped_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
