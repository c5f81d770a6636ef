"""Session defaults shared by batch and streaming jobs."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str = "tickloom", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Windows cost much per byte, so small partitions are worth a task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def wall_clock(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: all times are zoneless wall-clock values."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same context, own settings) for stateful queries.

    A stateful job keeps its partition count for life, so it takes the configured
    one. Only a local master, whose cores never change, gets at most two per core.
    """
    sibling = spark.newSession()
    wall_clock(sibling)
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.sparkContext.master.startswith("local"):
        partitions = min(partitions, 2 * spark.sparkContext.defaultParallelism)
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sibling


_local_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    Only where that is unset and all runs in one process, as in local tests, a
    temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="tickloom-"))
    return _local_folder[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_folder(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again.

    What it was made from is read once however often the result is used, and the
    planner knows its size: it broadcasts the table if that is below its threshold
    and shuffles otherwise.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package() -> None:
    """Sends this package's functions to Python workers by value, so that no
    installation is needed there."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
