"""Tables written between stages, in the folder the cluster shares.

A frame that is read more than once (for its statistics and again for its rows)
is written once and read back, so its plan runs once and an executor lost later
never sends the job back to the source tables.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_paths: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else a temporary one in local mode only."""
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="areascore-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table written by this session."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def release(spark: SparkSession) -> None:
    """Delete every scratch table of this session; frames that read them are no longer usable."""
    while _paths:
        remove_path(spark, _paths.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_sized(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """:func:`materialize`, with the bytes the table takes up."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    summary = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop_path)
    return spark.read.schema(df.schema).parquet(path), summary.getLength()
