"""Session and shared-storage helpers for tests, the bench and scripts.

Library operators never create a session. On a cluster the session comes
from the deployment; ``local_session`` is for tests and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "hitlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HITLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def parallelism(spark: SparkSession) -> int:
    """Task slots of the session (the configured shuffle partitions without a context)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Used for lineage cuts and written intermediate tables, so they survive
    the loss of any executor. Only when the session has none (local tests)
    is a fresh local folder created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. Spark Connect)
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set") from None
    current = sc.getCheckpointDir() or configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: intermediate tables need a folder shared by all executors"
        )
    local = tempfile.mkdtemp(prefix="hitlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def stored_table_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a written intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables written under the shared folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_dir(spark).rstrip("/")
    for path in paths:
        if not path.startswith(root + "/"):
            raise ValueError(f"{path} is not under {root}")
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written there to the end."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


# Whether a query's shuffle files are deleted when it ends; if not, they stay until the driver's memory is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """A write inside leaves no shuffle files behind, so the steps of a job don't add up on disk."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Intermediates:
    """Tables written under the shared folder for the length of one job.

    Each cuts the lineage (a lost executor doesn't rerun what made it) and has
    a size that the planner knows.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = stored_table_path(self.spark, name)
        with shuffles_released(self.spark):
            df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        drop_stored(self.spark, *self.paths)
        self.paths = []
