"""Token ids as Parquet list columns that can be read in part.

Documents lie in ascending ``doc_id`` order over the files and within them. Ids are dictionary
encoded; row groups and pages are small enough for the footer's statistics and the page index to
leave out what a filter on ``doc_id`` does not need; the metadata columns can be read without the ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.llm.shared import documents
from clickflow.llm.tokens import token_lists
from clickflow.scratch import fresh_dir

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1_000


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
    added: bool = False,
) -> None:
    """Encode ``doc_id, text`` and write ``doc_id, n_tokens, ids`` to a new folder.

    Texts, which are smaller than their ids, are range-partitioned; equal ids are told apart by their
    place in the input, so that a repeated id is not bound to one task. A null text is written
    as the end id alone, a null ``doc_id`` comes first. With ``added``, strings of the file's added tokens get their ids. Files are committed by Spark's writer.
    """
    ordered = (
        docs.select("doc_id", "text")
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
    )
    tokens = token_lists(ordered, tokenizer, True, end_id, added)
    (
        tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
        .write.option("compression", "zstd")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )


_SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids``; only documents from ``low`` to ``high``, whose pages alone are read."""
    table = spark.read.schema(_SCHEMA).parquet(path)
    if low is not None:
        table = table.where(F.col("doc_id") >= low)
    if high is not None:
        table = table.where(F.col("doc_id") <= high)
    return table


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """``file, row, doc_id, n_tokens, start`` without reading any id.

    ``start`` counts the ids of all documents before. Sums within a file are a window over its rows;
    the sums before each file are a window over one row per file.
    """
    table = spark.read.schema(_SCHEMA).parquet(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        "doc_id",
        "n_tokens",
    )
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(part, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        table.groupBy("file")
        .agg(F.sum("n_tokens").alias("file_tokens"))
        .select("file", F.coalesce(F.sum("file_tokens").over(earlier), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        table.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(files, "file")
        .select("file", "row", "doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(2)
        offsets = ids.offsets.to_numpy()
        data = memoryview(ids.values.cast(pa.uint32()).to_numpy().astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sums, pa.int64())], ["file", "row", "ids_crc32"]
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document in the files: ``doc_id, start, n_tokens, ids_crc32``, all from what is read back."""
    sums = (
        spark.read.schema(_SCHEMA).parquet(path)
        .select(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("row"),
            F.coalesce("ids", F.array().cast("array<int>")).alias("ids"),
        )
        .mapInArrow(_checksums, "file string, row long, ids_crc32 long")
    )
    return (
        read_places(spark, path)
        .join(sums, ["file", "row"])
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, added=True)
    return token_digests(spark, path)
