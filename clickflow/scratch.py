"""Working folders that every executor can reach."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"clickflow-{application}-")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is missing *and* the session is local,
    where driver and tasks share one disk.
    """
    root = spark.conf.get(_SETTING, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        root = _local_root(spark.sparkContext.applicationId)
    return root.rstrip("/")


_MADE: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def delete_scratch(spark: SparkSession) -> None:
    """Drop the tables and delete the folders that this session was given below the shared root."""
    context = spark.sparkContext
    for name in _TABLES.pop(context.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    hadoop = context._jvm.org.apache.hadoop.fs
    for name in _MADE.pop(context.applicationId, []):
        path = hadoop.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _delete_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        delete_scratch(spark)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no earlier run has used. Nothing is created there.

    Whatever is written there goes when the program ends, or by ``delete_scratch`` earlier.
    """
    name = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _MADE and not _TABLES:
        atexit.register(_delete_at_exit)
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def fresh_table(spark: SparkSession, label: str) -> str:
    """A table name that no earlier run has used. The catalog's entry goes as a ``fresh_dir`` does."""
    name = f"{label}_{uuid.uuid4().hex}"
    if not _MADE and not _TABLES:
        atexit.register(_delete_at_exit)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name
