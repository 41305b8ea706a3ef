"""Starting a stream, or continuing it from its checkpoint."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from clickflow.sinks.files import BatchSink

_PARTITIONS_SETTING = "spark.sql.shuffle.partitions"
_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROCKSDB_SETTING = "spark.sql.streaming.stateStore.rocksdb"
#: A process holds a store for each piece of the state. They share one bound of memory, take no disk before they use it, and
#: do not look up a row before each write to count rows. Values that the session sets go before.
_ROCKSDB_SETTINGS = {
    f"{_ROCKSDB_SETTING}.boundedMemoryUsage": "true",
    f"{_ROCKSDB_SETTING}.allowFAllocate": "false",
    f"{_ROCKSDB_SETTING}.trackTotalNumberOfRows": "false",
}


@contextmanager
def _setting(spark: SparkSession, key: str, value: object | None) -> Iterator[None]:
    """The setting while a stream starts; the stream keeps its own copy of it in the checkpoint.

    The session has one value, so a query that another thread plans meanwhile gets it, too.
    """
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def start(
    stream: DataFrame,
    checkpoint: str,
    sink: BatchSink | str,
    output_mode: str = "append",
    interval: str | None = None,
    fmt: str = "parquet",
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start the stream, or continue where the checkpoint stands.

    ``sink`` is a ``foreachBatch`` function or the path of a directory to append files to.
    ``interval`` ("5 seconds") is the time between batches; without it the stream works off what
    is there and ends. The checkpoint must be in a folder that all executors share.

    ``state_partitions`` is the number of pieces the state is kept in. The first start writes it
    into the checkpoint and it cannot be changed later, nor does adaptive execution apply, so it
    should suit the number of keys expected; the default is the session's shuffle setting.

    ``state_store`` is the class of the state store provider, such as ``ROCKSDB``, which ``transformWithState``
    (``running_state``) needs; it holds the state on disk, in bounded memory, where the default store holds it in the
    executors' heap. Like the number of pieces, the first start writes it into the checkpoint; the default
    is the session's setting.
    """
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    if isinstance(sink, str):
        writer = writer.format(fmt).option("path", sink)
    else:
        writer = writer.foreachBatch(sink)
    spark = stream.sparkSession
    settings = {_PARTITIONS_SETTING: state_partitions, _STORE_SETTING: state_store}
    if state_store == ROCKSDB:
        settings |= {key: spark.conf.get(key, None) or value for key, value in _ROCKSDB_SETTINGS.items()}
    with ExitStack() as held:
        for key, value in settings.items():
            held.enter_context(_setting(spark, key, value))
        return writer.start()


def run(
    stream: DataFrame,
    checkpoint: str,
    sink: BatchSink | str,
    output_mode: str = "append",
    interval: str | None = None,
    fmt: str = "parquet",
    state_partitions: int | None = None,
    timeout: float | None = None,
    state_store: str | None = None,
) -> bool:
    """Start the stream and wait until it ends or ``timeout`` seconds have passed.

    After the timeout the stream is stopped. Returns whether it ended by itself; an error of the
    stream is raised here.
    """
    query = start(stream, checkpoint, sink, output_mode, interval, fmt, state_partitions, state_store)
    try:
        ended = query.awaitTermination() if timeout is None else query.awaitTermination(timeout)
        return ended is not False
    finally:
        query.stop()
