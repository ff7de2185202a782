"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def base(spark: SparkSession) -> str:
    """The application's own folder below spark.checkpoint.dir; a temporary one only where that is unset in a local session."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkweave-"))
        top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/linkweave-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder in base."""
    return f"{base(spark)}/{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str) -> tuple:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    fs, found = _path(spark, path)
    fs.delete(found, True)
