"""Streams: per-batch, running and window counts, restart, late rows, time limits."""

from __future__ import annotations

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickflow import operators, scratch, sinks, streaming
from tests.conftest import rows


def deliver(directory, name, text):
    directory.mkdir(exist_ok=True)
    (directory / name).write_text(text)


@pytest.fixture
def dirs(tmp_path):
    """Inbox, checkpoint and output of one stream."""
    return tmp_path / "in", str(tmp_path / "chk"), str(tmp_path / "out")


def batches(spark, out):
    return rows(sinks.read_batches(spark, out).select("batch_id", "word", "cnt"))


def test_each_batch_is_counted_alone(spark, dirs):
    inbox, checkpoint, out = dirs
    deliver(inbox, "1.txt", "a b\na\n")
    time.sleep(1.1)
    deliver(inbox, "2.txt", "c a\n")
    lines = streaming.file_lines(spark, str(inbox), max_files=1)
    assert streaming.run(lines, checkpoint, streaming.batch_word_count(sinks.batch_files(out)))
    assert batches(spark, out) == [(0, "a", 2), (0, "b", 1), (1, "a", 1), (1, "c", 1)]


@pytest.mark.parametrize(
    ("mode", "second"),
    [("complete", [(1, "a", 3), (1, "b", 1), (1, "c", 1)]), ("update", [(1, "a", 3), (1, "c", 1)])],
)
def test_running_count_survives_a_restart(spark, dirs, mode, second):
    inbox, checkpoint, out = dirs
    for name, text in (("1.txt", "a b\na\n"), ("2.txt", "c a\n")):
        deliver(inbox, name, text)
        counts = streaming.running_word_count(streaming.file_lines(spark, str(inbox)))
        streaming.run(counts, checkpoint, sinks.batch_files(out), output_mode=mode)
    assert batches(spark, out) == [(0, "a", 2), (0, "b", 1), *second]


def test_nothing_new_after_a_restart(spark, dirs):
    inbox, checkpoint, out = dirs
    deliver(inbox, "1.txt", "a\n")
    sink = streaming.batch_word_count(sinks.batch_files(out))
    for _ in range(2):
        streaming.run(streaming.file_lines(spark, str(inbox)), checkpoint, sink)
    assert batches(spark, out) == [(0, "a", 1)]


def test_state_partitions(spark, dirs):
    inbox, checkpoint, out = dirs
    before = spark.conf.get("spark.sql.shuffle.partitions")
    deliver(inbox, "1.txt", "a b\na\n")
    query = streaming.start(
        streaming.running_word_count(streaming.file_lines(spark, str(inbox))),
        checkpoint,
        sinks.batch_files(out),
        output_mode="update",
        state_partitions=3,
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert batches(spark, out) == [(0, "a", 2), (0, "b", 1)]


def test_batches_into_a_table(spark, dirs, tmp_path):
    inbox, checkpoint, _ = dirs
    url = f"jdbc:derby:;databaseName={tmp_path}/db;create=true"
    for name, text in (("1.txt", "a b\na\n"), ("2.txt", "c a\n")):
        deliver(inbox, name, text)
        counts = streaming.running_word_count(streaming.file_lines(spark, str(inbox)))
        streaming.run(counts, checkpoint, sinks.batch_jdbc(url, "counts"), output_mode="update")
    expected = [("a", 2, 0), ("a", 3, 1), ("b", 1, 0), ("c", 1, 1)]
    assert rows(spark.read.jdbc(url, "counts")) == expected


def test_an_error_of_the_stream_is_raised(spark, dirs):
    inbox, checkpoint, _ = dirs
    deliver(inbox, "1.txt", "a\n")

    def broken(batch, batch_id):
        raise RuntimeError("sink is gone")

    with pytest.raises(Exception, match="sink is gone"):
        streaming.run(streaming.file_lines(spark, str(inbox)), checkpoint, broken)


def test_interval_and_timeout(spark, dirs):
    inbox, checkpoint, out = dirs
    deliver(inbox, "1.txt", "a\n")
    started = time.monotonic()
    ended = streaming.run(
        streaming.file_lines(spark, str(inbox)),
        checkpoint,
        streaming.batch_word_count(sinks.batch_files(out)),
        interval="1 second",
        timeout=8,
    )
    assert ended is False
    assert 8 <= time.monotonic() - started < 30
    assert batches(spark, out) == [(0, "a", 1)]
    assert spark.streams.active == []


def write_events(spark, inbox, number, *times):
    df = spark.createDataFrame([(f"2024-01-01 {t}", "k") for t in times], "t string, key string")
    typed = df.select(F.to_timestamp("t").alias("ts"), "key")
    typed.coalesce(1).write.mode("append").parquet(str(inbox / f"part={number}"))
    time.sleep(1.1)


def test_windows_and_late_rows(spark, dirs):
    """A row is judged by the watermark of the batch before it."""
    inbox, checkpoint, out = dirs
    write_events(spark, inbox, 1, "10:00:01", "10:00:05")
    write_events(spark, inbox, 2, "10:01:00")
    write_events(spark, inbox, 3, "10:00:02")  # one batch after the jump: still counted
    write_events(spark, inbox, 4, "10:00:03")  # two batches after: dropped
    write_events(spark, inbox, 5, "10:05:00")
    schema = "ts timestamp, key string, part int"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    counts = streaming.window_count(
        reader.parquet(str(inbox)), "ts", "key", "12 seconds", "6 seconds", "2 seconds"
    )
    streaming.run(counts, checkpoint, out)
    got = {
        (r.window_start, r.window_end): r.cnt for r in spark.read.parquet(out).collect()
    }

    def at(text):
        return datetime.fromisoformat(f"2024-01-01 {text}")

    assert got == {
        (at("09:59:54"), at("10:00:06")): 3,
        (at("10:00:00"), at("10:00:12")): 3,
        (at("10:00:54"), at("10:01:06")): 1,
        (at("10:01:00"), at("10:01:12")): 1,
    }


def test_kafka_values(spark):
    records = spark.createDataFrame(
        [(b"k", b"a b", "t", 0, 1), (None, "ü a".encode(), "t", 1, 7), (b"k", None, "t", 0, 2)],
        "key binary, value binary, topic string, partition int, offset long",
    )
    lines = streaming.decode_values(records)
    assert lines.columns == ["value"]
    assert rows(operators.word_count(operators.words(lines))) == [("a", 2), ("b", 1), ("ü", 1)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streaming.kafka_lines(spark, "localhost:1", ["a", "b"], max_offsets=10)


@pytest.mark.parametrize("name", ["events.parquet", "folder.parquet"])
def test_parquet_stream_of_file_or_folder(spark, sf_dir, dirs, tmp_path, name):
    _, checkpoint, out = dirs
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = f"{sf_dir}/{name}"
    if name.startswith("folder"):
        path = str(tmp_path / name)
        events.repartition(3).write.parquet(path)
    streaming.run(streaming.parquet_rows(spark, path, max_files=2), checkpoint, out)
    assert spark.read.parquet(out).count() == events.count()


def test_scratch_folders(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.fresh_dir(spark, "x"), scratch.fresh_dir(spark, "x")
    assert first != second
    assert first.startswith(root + "/x-")


def test_scratch_is_local_only_where_nothing_is_set():
    class Local:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "local[2]"
            applicationId = "some-app"

    root = scratch.shared_root(Local())
    assert root == scratch.shared_root(Local())
    assert "some-app" in root


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch.shared_root(Cluster())


def test_parquet_rows_of_a_partitioned_table(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    table = spark.range(20).withColumn("part", F.col("id") % 3)
    table.write.partitionBy("part").parquet(path)
    streaming.run(streaming.parquet_rows(spark, path), str(tmp_path / "chk"), out)
    assert rows(spark.read.parquet(out).select("id", F.col("part").cast("long"))) == rows(table)


def test_replayed_batch_keeps_its_time(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    spark.createDataFrame([("a b",)], "value string").write.text(inbox)
    sink = streaming.batch_word_count(sinks.batch_files(out))

    def run():
        lines = sinks.with_batch_time(streaming.file_lines(spark, inbox))
        streaming.run(lines, checkpoint, sink)
        return rows(sinks.read_batches(spark, out).select("word", "batch_time"))

    first = run()
    for name in ("0", ".0.crc"):  # as after a crash between output and commit
        (tmp_path / "chk" / "commits" / name).unlink(missing_ok=True)
    time.sleep(1.2)
    assert run() == first and len(first) == 2


def test_decoded_records_keep_their_time(spark):
    records = spark.createDataFrame([(b"x y", 5)], "value binary, timestamp int")
    got = streaming.decode_values(records, keep=["timestamp"])
    assert rows(got) == [(5, "x y")]
    assert streaming.decode_values(records).columns == ["value"]


def test_partition_setting_is_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    inbox = str(tmp_path / "in")
    spark.createDataFrame([("a",)], "value string").write.text(inbox)
    counts = streaming.running_word_count(streaming.file_lines(spark, inbox))
    sink = sinks.batch_files(str(tmp_path / "out"))
    streaming.run(counts, str(tmp_path / "chk"), sink, output_mode="update", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_is_deleted(spark):
    path = scratch.fresh_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    kept = dict(scratch._MADE)
    scratch._MADE.clear()
    scratch._MADE[spark.sparkContext.applicationId] = [path]
    table, tables = scratch.fresh_table(spark, "gone"), dict(scratch._TABLES)
    spark.range(3).write.option("path", path + "/table").saveAsTable(table)
    scratch._TABLES.clear()
    scratch._TABLES[spark.sparkContext.applicationId] = [table]
    scratch.delete_scratch(spark)
    assert not spark.catalog.tableExists(table)
    scratch._MADE.update(kept)
    scratch._TABLES.update({a: [n for n in names if n != table] for a, names in tables.items()})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
