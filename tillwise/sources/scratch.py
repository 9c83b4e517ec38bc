"""Intermediate tables in the folder the cluster shares.

A frame that several jobs read, or whose physical row order matters, is written once and read back.
The files survive the loss of any executor, and unlike ``checkpoint()`` they keep column pruning,
filter pushdown and true sizes for the optimizer.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
FOLDER = "_folder"  # column by which ``materialise`` writes a folder each
_TASK_BYTES = 64 << 20  # of one folder's files to a task
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_OPEN = 64  # files that a task keeps open at most


@lru_cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="tillwise-")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    A machine-local folder is only taken where nothing is set and the session is local anyway.
    """
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        root = _local_root(context.applicationId)
    return f"{root.rstrip('/')}/tillwise/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a scratch table and return the frame that reads it; with ``FOLDER``, by ``materialise_by``."""
    if FOLDER in df.columns:
        return materialise_by(df, FOLDER, label)
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes by the values of a column, made within, keep a file open for each value a task meets.

    Otherwise Spark sorts the rows of a task by value first, and a task with a large file of its own spills them. What
    comes after ``_OPEN`` values is sorted still.
    """
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(_OPEN))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def materialise_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """``materialise`` into one folder for each of the few values of ``column``, which is left out of the result.

    The frame is a union of one scan per folder, so no task that reads it meets rows of two values. Rows get together as
    columns in files instead of one by one in a shuffle, which takes well over twice the bytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with open_files(spark):
        df.write.option("compression", "zstd").partitionBy(column).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    schema, scans = df.drop(column).schema, []
    for status in system.listStatus(folder):
        if status.getPath().getName().startswith(f"{column}="):
            held = system.getContentSummary(status.getPath()).getLength()
            rows = spark.read.schema(schema).parquet(f"{path}/{status.getPath().getName()}")
            # the folders together keep the cores busy, so small ones need not be split for that; scans of one task each
            # would be put together into a single one by the union
            scans.append(rows.coalesce(max(2, -(-held // _TASK_BYTES))))
    return reduce(DataFrame.unionAll, scans) if scans else spark.createDataFrame([], schema)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote. Frames built on it can no longer be read."""
    discard(spark, scratch_root(spark))
