"""Session defaults and the shared folder for tables that a job writes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM compiles no method beyond this size. Wide rows of parsed text exceed it as one generated method, which is
    # then interpreted; as single operators they are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keys seen by a stream are kept on local disk and in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings that the operators count on."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


#: Has Spark remove the shuffles of a job when it ends; otherwise they lie on disk until the driver collects garbage.
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started within leave no shuffles behind."""
    before = spark.conf.get(SHUFFLES_REMOVED)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_REMOVED, before)


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallymint")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    return configure(builder.getOrCreate())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallymint-")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder of the cluster.

    The place is ``spark.checkpoint.dir``. Only a local session that has none falls back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/tallymint/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder below a workspace that no later job reads; Spark's own file systems reach it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
