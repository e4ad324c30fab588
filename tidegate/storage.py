"""Shared-folder helpers: scratch space and the few file operations Spark's API lacks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .errors import OptionError


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster
    a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise OptionError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
    return context.getCheckpointDir().rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidegate/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder, below one folder per application."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch data of this application; results that read it become invalid."""
    remove(spark, _scratch_root(spark))


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    if fs.exists(hadoop_path):
        fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, none if it is missing."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    hadoop_path, fs = _file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; an existing one is an error."""
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
