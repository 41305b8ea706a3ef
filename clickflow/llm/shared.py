"""What several operators share: written intermediate tables and column checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from clickflow.scratch import fresh_dir
from clickflow.storage import delete_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run meanwhile go when each of them ends, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage so that a costly table is computed once; the files outlive lost executors.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if _SCOPES:
        _SCOPES[-1].append((spark, path))
    with _shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def free(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    delete_path(table.sparkSession, table.scratch_path)


_SCOPES: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def freeing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete, in the end, what ``written`` wrote meanwhile. The function given marks a written table as one to keep.

    A kept table belongs to the scope outside. Nothing that is read later may depend on the others.
    """
    own: list[tuple[SparkSession, str]] = []
    kept: set[str] = set()

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table.scratch_path)
        return table

    _SCOPES.append(own)
    try:
        yield keep
    finally:
        _SCOPES.remove(own)
        for spark, path in own:
            if path not in kept:
                delete_path(spark, path)
            elif _SCOPES:
                _SCOPES[-1].append((spark, path))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
