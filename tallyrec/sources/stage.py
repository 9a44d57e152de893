"""Stage tables: results several later steps read, written once to shared storage.

A stage table cuts the lineage without tying it to an executor: losing any
number of executors never loses a finished stage.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths given out inside each open :func:`temporary_stages`.
_given: list[list[str]] = []


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallyrec-stage-")


def stage_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one in local mode only."""
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    return _local_root()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the stage root that no other run uses."""
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _given:
        paths.append(path)
    return path


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Stage tables written inside are removed at the end; nothing lazy may read them afterwards."""
    paths: list[str] = []
    _given.append(paths)
    try:
        yield
    finally:
        _given.remove(paths)
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in paths:
            at = files.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def passing_work(spark: SparkSession) -> Iterator[None]:
    """As :func:`temporary_stages`; shuffle files of a finished job are removed too, where Spark (4.1) can.

    For work done slice by slice: what one slice has left on disk is gone before the next.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        with temporary_stages(spark):
            yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a stage table and return a scan of it.

    ``partition_by`` may name a column with a handful of labels; a later filter
    on it then reads only the matching files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
