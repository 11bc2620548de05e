"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MB = 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are joined without a hint: Spark broadcasts a side while its size,
    # as estimated from its files, is under the stock threshold or, as measured
    # during the run, under this one.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    # Plans are built from many small expressions, and each would ask the JVM several
    # times for the Python line that it comes from, to name it in error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Three hours of row keys need not fit in memory, and only changes are saved.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with this library's settings; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors and the driver share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other caller has."""
    return f"{shared_root(spark)}/edgeledger/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` computed once and read from the shared folder, so that filters reach the files."""
    path = path or scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settling(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``settle`` for one job; what it wrote is deleted when the job ends."""
    folder = scratch_path(spark, "job")
    try:
        yield lambda df: settle(df, f"{folder}/{uuid.uuid4().hex}")
    finally:
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder that this library made another place, where none may be; nothing if it isn't there."""
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    system = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(paths[0]) and not system.rename(*paths):
        raise OSError(f"{source} can't be moved to {target}")
