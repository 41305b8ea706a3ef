"""Batch files under a commit log: readers see a batch whole, as it was or as it is now, and never in between.

Every attempt at a batch writes to a folder of its own. When all files are there, an entry in the log names that
folder; an entry appears by a rename and is never changed. A batch that runs again adds an entry with a higher
number. Readers follow the log, so files of attempts that died, or are still at work, are never read.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickflow.sinks.files import BATCH_TIME, BatchSink, with_batch_time
from clickflow.storage import delete_path, names_in, rename_path, write_bytes


class Commit(NamedTuple):
    batch_id: int
    number: int
    attempt: str

    @property
    def folder(self) -> str:
        return f"data/batch_id={self.batch_id}/attempt={self.attempt}"


def _entries(spark: SparkSession, path: str) -> list[Commit]:
    found = []
    for name in names_in(spark, f"{path}/log"):
        parts = name.split("-")
        if len(parts) == 3 and parts[0].isdigit():
            found.append(Commit(int(parts[0]), int(parts[1]), parts[2]))
    return found


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The attempt that counts of every batch, by the names in the log: one short name per batch and attempt."""
    last: dict[int, Commit] = {}
    for entry in sorted(_entries(spark, path)):
        last[entry.batch_id] = entry
    return list(last.values())


def logged_batches(path: str, fmt: str = "parquet", partitions: int | None = None) -> BatchSink:
    """A ``foreachBatch`` function that writes each batch below ``path`` and then commits it to the log.

    Rows without ``batch_time`` get the time of writing. A replayed batch takes the place of its earlier files, which
    stay until ``delete_replaced``. The storage must rename a file in one step, as HDFS and local disks do.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        attempt = uuid.uuid4().hex
        out = batch if BATCH_TIME in batch.columns else with_batch_time(batch)
        if partitions is not None:
            out = out.coalesce(partitions)
        number = 1 + max((e.number for e in _entries(spark, path) if e.batch_id == batch_id), default=-1)
        commit = Commit(batch_id, number, attempt)
        out.write.mode("error").format(fmt).save(f"{path}/{commit.folder}")
        draft = f"{path}/log/_{attempt}"
        write_bytes(spark, draft, b"")
        rename_path(spark, draft, f"{path}/log/{batch_id:012d}-{number:06d}-{attempt}")

    return sink


def read_logged(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """All committed batches as of now, with their ``batch_id``. Batches without rows may be among them.

    ``schema`` (without ``batch_id``) saves the pass that infers types; with it, no batch gives no row.
    """
    folders = [f"{path}/{commit.folder}" for commit in commits(spark, path)]
    reader = spark.read.format(fmt).option("basePath", f"{path}/data")
    if schema is not None:
        columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        full = StructType([*columns.fields]).add("batch_id", "long").add("attempt", "string")
        if not folders:
            return spark.createDataFrame([], full).drop("attempt")
        reader = reader.schema(full)
    elif not folders:
        raise ValueError(f"nothing is committed below {path}; give a schema to read it as empty")
    return reader.load(folders).drop("attempt").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def delete_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files of attempts that do not count. Call it when no reader and no writer is at work."""
    kept = {commit.attempt for commit in commits(spark, path)}
    gone = 0
    for batch in names_in(spark, f"{path}/data"):
        for attempt in names_in(spark, f"{path}/data/{batch}"):
            if attempt.removeprefix("attempt=") not in kept:
                gone += delete_path(spark, f"{path}/data/{batch}/{attempt}")
    return gone
