"""File outputs, of a batch job or of every micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BatchSink = Callable[[DataFrame, int], None]

BATCH_TIME = "batch_time"
# How the time of a batch is written.
BATCH_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def with_batch_time(df: DataFrame) -> DataFrame:
    """The rows with ``batch_time``, as text in the session's time zone.

    On a streaming table this is the time of each micro-batch, which Spark records with the batch and repeats
    when it is replayed.
    """
    return df.withColumn(BATCH_TIME, F.date_format(F.current_timestamp(), BATCH_TIME_FORMAT))


def _tsv_line(df: DataFrame, null_value: str) -> Column:
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_value)) for c in df.columns]
    return F.concat_ws("\t", *columns).alias("value")


def write_tsv(df: DataFrame, path: str, null_value: str = "null") -> None:
    """The columns of each row as one text line with tabs between them. The path must be new."""
    df.select(_tsv_line(df, null_value)).write.mode("error").text(path)


def batch_files(path: str, fmt: str = "parquet", partitions: int | None = None) -> BatchSink:
    """A ``foreachBatch`` function that writes each batch to ``path/batch_id=N``.

    Rows without ``batch_time`` get the time of writing; give the stream its own by ``with_batch_time``.
    A replayed batch replaces its own directory, so nothing is doubled after a restart. ``partitions`` asks
    for fewer files, by a coalesce.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = batch if BATCH_TIME in batch.columns else with_batch_time(batch)
        if partitions is not None:
            out = out.coalesce(partitions)
        out.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return sink


def batch_tsv(path: str, null_value: str = "null") -> BatchSink:
    """The same as text lines, with the columns of the batch as they are."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(_tsv_line(batch, null_value))
        lines.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return sink


def read_batches(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """All batches written by a batch sink, with their ``batch_id``.

    ``schema`` (without ``batch_id``) saves the pass that infers types; with it, no batch gives no row.
    """
    reader = spark.read.format(fmt)
    if schema is None:
        found = reader.load(path)
    else:
        columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        full = StructType([*columns.fields]).add("batch_id", "long")
        try:
            found = reader.schema(full).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], full)
    return found.withColumn("batch_id", F.col("batch_id").cast("bigint"))
