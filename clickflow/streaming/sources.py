"""Line and row streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a directory, in a column named ``value``.

    ``max_files`` bounds the files of one micro-batch.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def parquet_rows(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Rows of a Parquet table, a directory or a single file, as a stream."""
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream takes a directory, which may be partitioned, but no file name: of a file, its directory
    # with a filter on the name.
    if [f.rstrip("/").rpartition("/")[2] for f in table.inputFiles()] == [path.rpartition("/")[2]]:
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def decode_values(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The text of Kafka records, one line per record.

    ``keep`` names record columns to pass on; ``timestamp`` is the time a record has by its topic's setting:
    when it was made, or when it arrived.
    """
    return records.select(*keep, F.col("value").cast("string").alias("value"))


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topics: str | Iterable[str],
    starting: str = "latest",
    max_offsets: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines of Kafka topics, read by the executors straight from the brokers.

    Needs Spark's Kafka connector on the classpath. ``max_offsets`` bounds one micro-batch;
    without it the first batch after a pause takes everything that has piled up. ``keep`` is that of
    ``decode_values``.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", names)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode_values(reader.load(), keep)
