"""The folder all executors can reach, for data that must outlive one executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the session's `spark.checkpoint.dir`.

    A machine-local folder is used only in local mode and only where the setting is absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="logwarden-")
    return f"{root.rstrip('/')}/logwarden/{purpose}-{uuid.uuid4().hex}"


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """A stream can read a folder before anything is written to it, but it must be there."""
    folder, system = _open(spark, path)
    system.mkdirs(folder)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder, by name; none where it does not exist."""
    folder, system = _open(spark, path)
    if not system.exists(folder):
        return []
    found = [status for status in system.listStatus(folder) if status.isDirectory()]
    return sorted(f"{path}/{status.getPath().getName()}" for status in found)
