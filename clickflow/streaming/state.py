"""Running state with a function of one's own, and state that is read from a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickflow.operators.words import words
from clickflow.streaming.windows import _micros

Update = Callable[[Iterator[Any], Any], Any]


# Columns as the processor sees them.
_VALUE, _TIME = "_value", "_ms"


class _Running(StatefulProcessor):
    """The state of one key: a value, and the time of its last row in milliseconds where idle keys are forgotten.

    A key has one timer. It is not moved by later rows; when it fires too early it is set again.
    """

    def __init__(self, key: str, value: str, update: Update, kind: str, ts: str | None, idle_ms: int | None):
        self.key, self.value, self.update, self.kind = key, value, update, kind
        self.ts, self.idle_ms = ts, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"value {self.kind}, last bigint")
        self.out = Row(self.key, "state", "expired")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.state.get()
        old, last = (None, None) if held is None else held

        def values() -> Iterator[Any]:
            nonlocal last
            for row in rows:
                if self.ts is not None:
                    last = row[self.ts] if last is None else max(last, row[self.ts])
                yield row[self.value]

        given = values()
        new = self.update(given, old)
        for _ in given:  # the time of rows that the function left unread counts, too
            pass
        if new is None:
            self.state.clear()
            return
        self.state.update((new, last))
        if held is None and self.idle_ms is not None:
            self.handle.registerTimer(last + self.idle_ms)
        yield self.out(key[0], new, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.state.get()
        if held is None:
            return
        end = held[1] + self.idle_ms
        if end > expiredTimerInfo.getExpiryTimeInMs() and end > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(end)
            return
        self.state.clear()
        yield self.out(key[0], held[0], True)

    def close(self) -> None:
        pass


def running_state(
    df: DataFrame,
    key: str,
    value: str,
    update: Update,
    kind: str = "bigint",
    ts: str | None = None,
    idle: str | None = None,
    watermark: str = "0 seconds",
) -> DataFrame:
    """A state per key, changed by ``update(values, old)``: the key, ``state`` and ``expired``.

    ``update`` gets an iterator over the key's new values and the old state, or None where there is none, and returns
    the new state, or None to forget the key. ``kind`` is the state's SQL type. Each batch gives one row for
    every key it changed; run it in output mode ``update`` with the RocksDB state store (``state_store=ROCKSDB``).

    With ``idle`` a key is forgotten when the watermark has passed the time ``ts`` of its last row by that much; a
    last row with ``expired`` says so. A later row starts a new state. Rows behind the watermark are dropped then.
    For counts, sums and the like the built-in aggregates are faster: they keep their state in the JVM.
    """
    if (ts is None) != (idle is None):
        raise ValueError("ts and idle go together")
    rows = df.select(F.col(key), F.col(value).alias(_VALUE))
    mode, idle_ms = "none", None
    if ts is not None:
        mode, idle_ms = "eventTime", _micros(df.sparkSession, idle) // 1_000
        timed = df.withWatermark(ts, watermark)
        rows = timed.select(F.col(key), F.col(value).alias(_VALUE), ts, F.unix_millis(ts).alias(_TIME))
    out = f"`{key}` {dict(rows.dtypes)[key]}, state {kind}, expired boolean"
    processor = _Running(key, _VALUE, update, kind, None if ts is None else _TIME, idle_ms)
    return rows.groupBy(key).transformWithState(processor, out, "Update", mode)


def add_count(values: Iterator[Any], old: int | None) -> int:
    """An update function: the number of values so far."""
    return (old or 0) + sum(1 for _ in values)


# --- reading state ----------------------------------------------------------------------------


def read_counts(spark: SparkSession, checkpoint: str, key: str = "word") -> DataFrame:
    """``key, cnt`` as a running count has them in its checkpoint, read by the executors.

    The stream must not be running. The last batch that was committed counts.
    """
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names[0]
    return state.select(F.col(f"key.`{key}`").alias(key), F.col(f"value.`{value}`").alias("cnt"))


def state_partition_count(spark: SparkSession, checkpoint: str) -> int:
    """The number of pieces that the checkpoint keeps its state in."""
    return spark.read.format("state-metadata").load(checkpoint).first()["numPartitions"]


_SEEN = "path string, timestamp bigint, batchId bigint"


def _one_slash(path: Column) -> Column:
    """A path without a host may be written with one or three slashes."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):///", "$1:/")


def seen_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``path`` of the files that a file stream has taken, from its checkpoint."""
    log = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    return log.select(_one_slash(F.from_json("value", _SEEN)["path"]).alias("path")).distinct()


def resumed_file_lines(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Lines of the files that a stream with that checkpoint has not taken yet, for a stream with another one.

    The first batch of the new stream lists all files and drops the lines of the old ones.
    """
    lines = spark.readStream.text(path).select("value", _one_slash(F.col("_metadata.file_path")).alias("_file"))
    old = seen_files(spark, checkpoint).withColumnRenamed("path", "_file")
    return lines.join(old, "_file", "left_anti").select("value")


def redealt_word_count(lines: DataFrame, counts_path: str, column: str = "value") -> DataFrame:
    """A running word count that begins with the counts ``word, cnt`` written as Parquet below ``counts_path``.

    The number of state partitions is fixed by a checkpoint. To change it, write ``read_counts`` of the old one to a
    folder, and start this stream with a new checkpoint and another ``state_partitions``, on lines that the old
    stream has not taken (``resumed_file_lines``). The old counts are the first rows of the new stream, so that its
    first batch in output mode ``update`` gives every word. Restart it with the same arguments.
    """
    spark = lines.sparkSession
    known = spark.readStream.schema("word string, cnt bigint").parquet(counts_path)
    new = words(lines, column).select("word", F.lit(1).cast("bigint").alias("cnt"))
    return known.unionByName(new).groupBy("word").agg(F.sum("cnt").alias("cnt"))
