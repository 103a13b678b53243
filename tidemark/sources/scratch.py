"""Working folders on the storage all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the one the cluster names; a local one only where none is named."""
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(_SETTING, base)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of a table, on whatever file system it is; nothing happens if it is gone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the folders below `path`; none if it isn't there."""
    return list(folder_ages(spark, path, column))


def folder_ages(spark: SparkSession, path: str, column: str) -> dict[str, float]:
    """Values of a partition column and when their folders last changed, in seconds since 1970."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return {}
    found = [(status.getPath().getName(), status.getModificationTime() / 1000) for status in files.listStatus(folder)]
    return {name.split("=", 1)[1]: changed for name, changed in found if name.startswith(f"{column}=")}
