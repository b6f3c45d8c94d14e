"""Session settings and the places where a job may cut its lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "plumbline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution on; partition counts are left to AQE unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # small files of long texts become a task each, not one task of many files
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "4g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder, or a fresh one in local mode."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp" if os.path.isdir("/tmp") else None)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """df as a table written to the shared folder: computed once, read by every later use.

    Later stages survive the loss of executors without recomputing df, and reads are columnar.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name nobody used before, inside the shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for listed in _LISTENING:
        listed.append(folder)
    return folder


_LISTENING: list[list[str]] = []


@contextmanager
def folders_made() -> Iterator[list[str]]:
    """Names of the folders that are made inside the block, for a later remove_folders."""
    made: list[str] = []
    _LISTENING.append(made)
    try:
        yield made
    finally:
        _LISTENING.remove(made)


def remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Removes folders, in whatever store they are; those that are gone do not matter."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
