"""Counts per batch, since the start, and per sliding window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.words import word_count, words
from clickflow.sinks.files import BATCH_TIME, BatchSink


def batch_word_count(sink: BatchSink, column: str = "value") -> BatchSink:
    """A ``foreachBatch`` function: the word count of each batch of lines alone goes to ``sink``.

    Counting inside the batch keeps no state; a streaming ``groupBy`` would. The batch's time, if it has
    one, stays beside the counts.
    """

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        time = [BATCH_TIME] if BATCH_TIME in batch.columns else []
        found = words(batch, column, keep=time)
        counts = found.groupBy(*time, "word").agg(F.count(F.lit(1)).alias("cnt"))
        sink(counts.select("word", "cnt", *time), batch_id)

    return count_batch


def running_word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """The count of each word since the stream began. No word is ever forgotten.

    Output mode ``complete`` repeats every word in every batch; ``update`` gives only the words
    that the batch changed, which is the mode for a large vocabulary.
    """
    return word_count(words(lines, column))


def window_count(
    df: DataFrame, ts: str, key: str, length: str, slide: str, watermark: str
) -> DataFrame:
    """Rows per key in sliding windows over event time.

    A window is final once the watermark has passed its end; later rows for it are dropped. Output mode
    ``append`` writes final windows only, so the last ones of a finite input never; ``update`` writes a
    window whenever it changes, and its latest count is the one that holds. ``ts`` must be a timestamp
    with time zone.
    """
    window = F.window(ts, length, slide).alias("window")
    counts = df.withWatermark(ts, watermark).groupBy(window, key).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        "cnt",
    )


def window_word_count(
    lines: DataFrame,
    ts: str,
    length: str,
    slide: str,
    watermark: str,
    column: str = "value",
) -> DataFrame:
    """Word counts of timed lines in sliding windows: of Kafka lines read with ``keep=["timestamp"]``, for one."""
    return window_count(words(lines, column, keep=[ts]), ts, "word", length, slide, watermark)
