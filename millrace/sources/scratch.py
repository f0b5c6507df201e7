"""Shared scratch space: where lineage is cut and intermediate tables are kept."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []


def _shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode without one, a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="millrace-"))
    return _local_dirs[0].name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the session a checkpoint folder unless it has one already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory and on disk inside the block; a caller's own cache is left alone."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def release(spark: SparkSession) -> None:
    """Drop shuffle files and blocks of tables that nothing refers to any more.

    Spark does so once the driver has collected its garbage, which a driver with little to do puts off for
    half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
