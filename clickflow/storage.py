"""Single files and folders on the cluster's storage, through Hadoop's file systems."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str) -> tuple[Any, Any]:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with what is in it. False if there is none."""
    system, target = _opened(spark, path)
    return system.delete(target, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a new file; folders above it are made."""
    system, target = _opened(spark, path)
    out = system.create(target, False)
    out.write(content)
    out.close()


def rename_path(spark: SparkSession, path: str, new: str) -> None:
    """Give a file its final name, which no file may have yet."""
    system, source = _opened(spark, path)
    if not system.rename(source, _opened(spark, new)[1]):
        raise FileExistsError(f"{path} could not be renamed to {new}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what is in a folder; none if there is no folder."""
    system, target = _opened(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]
