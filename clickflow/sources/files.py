"""File scans: text, Hive-style text partitions, CSV, JSON, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in a column named ``value``."""
    return spark.read.text(path)


def text_partition(spark: SparkSession, root: str, column: str, value: str) -> DataFrame:
    """Lines of the partition directory ``root/column=value``, with the partition column added.

    Spark lists the partition directories and reads the files of that one alone. The value stays a
    string ("007" is not turned into 7); the empty string is stored as null and found again.
    """
    rows = spark.read.schema(f"value string, `{column}` string").text(root)
    if value == "":
        return rows.where(F.col(f"`{column}`").isNull()).withColumn(column, F.lit(""))
    return rows.where(F.col(f"`{column}`") == value)


def csv_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header row. Types are inferred unless ``schema`` is given.

    Inference reads the files one more time; give a schema for large inputs.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def json_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """JSON lines. The schema is inferred (one more pass over the files) unless given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
