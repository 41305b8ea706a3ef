"""Sliding windows put together from panes: over event time, and over batches as they arrive."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.words import words
from clickflow.sinks.files import BatchSink
from clickflow.storage import delete_path


def _micros(spark: SparkSession, interval: str) -> int:
    """An interval such as ``2 days`` in microseconds; a day has 24 hours. Months have no fixed length."""
    origin = "timestamp_ntz'1970-01-01 00:00:00'"
    text = f"timestampdiff(MICROSECOND, {origin}, {origin} + interval '{interval}')"
    if "month" in interval.lower() or "year" in interval.lower():
        raise ValueError(f"a window needs a fixed length, not {interval!r}")
    return spark.sql(f"SELECT {text} AS micros").first()["micros"]


def window_count_panes(df: DataFrame, ts: str, key: str, length: str, slide: str, watermark: str) -> DataFrame:
    """Rows per key in sliding windows over event time, each row aggregated once.

    A first stateful step counts panes that do not overlap, as long as the greatest length that ``length`` and
    ``slide`` are multiples of. When the watermark has passed a pane it goes to a second step, which adds it to the
    windows it lies in. ``window_count`` instead repeats each row for every window before it counts.

    Two steps need output mode ``append``: a window is written once, when it is final, so the last windows of a finite
    input come only when a later row moves the watermark. Rows behind the watermark are dropped.
    """
    spark = df.sparkSession
    pane = math.gcd(_micros(spark, length), _micros(spark, slide))
    panes = (
        df.withWatermark(ts, watermark)
        .groupBy(F.window(ts, f"{pane} microseconds").alias("pane"), key)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    windows = panes.groupBy(F.window("pane", length, slide).alias("window"), key).agg(F.sum("cnt").alias("cnt"))
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        "cnt",
    )


def window_word_count_panes(
    lines: DataFrame, ts: str, length: str, slide: str, watermark: str, column: str = "value"
) -> DataFrame:
    """``window_word_count`` from panes."""
    return window_count_panes(words(lines, column, keep=[ts]), ts, "word", length, slide, watermark)


def arrival_windows(path: str, key: str, length: int, slide: int) -> BatchSink:
    """A ``foreachBatch`` function: rows per key in the last ``length`` batches, after every ``slide`` batches.

    The counts of each batch are a pane, written once to ``path/panes``; a window is the sum of its panes, in
    ``path/windows``. Nothing is held between batches but these files: a batch that runs again after a failure replaces
    its pane and its window by the same content, and a restart goes on where the checkpoint stands. Panes that no later window
    needs are deleted. The first windows hold fewer batches. Batch numbers count batches that Spark ran, so a pause
    without data has none.
    """
    if length < 1 or slide < 1:
        raise ValueError("length and slide must be at least one batch")

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
        counts.write.mode("overwrite").parquet(f"{path}/panes/batch_id={batch_id}")
        first = max(0, batch_id - length + 1)
        if (batch_id + 1) % slide == 0:
            panes = [f"{path}/panes/batch_id={i}" for i in range(first, batch_id + 1)]
            window = spark.read.schema(counts.schema).parquet(*panes).groupBy(key).agg(F.sum("cnt").alias("cnt"))
            window.select(F.lit(first).cast("bigint").alias("first_batch"), key, "cnt").write.mode("overwrite").parquet(
                f"{path}/windows/last_batch={batch_id}"
            )
        # The batch itself may run again and needs what it read; the one before it is done.
        delete_path(spark, f"{path}/panes/batch_id={first - 1}")

    return sink


def read_arrival_windows(spark: SparkSession, path: str) -> DataFrame:
    """All windows written: ``first_batch, last_batch``, the key and ``cnt``."""
    found = spark.read.parquet(f"{path}/windows").withColumn("last_batch", F.col("last_batch").cast("bigint"))
    return found.select("first_batch", "last_batch", *[c for c in found.columns if not c.endswith("_batch")])


def each_batch(prepare: Callable[[DataFrame], DataFrame], sink: BatchSink) -> BatchSink:
    """A ``foreachBatch`` function that hands ``prepare(batch)`` to the sink."""
    return lambda batch, batch_id: sink(prepare(batch), batch_id)
