"""Windows from panes and by arrival, own state functions, state read from checkpoints."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickflow import sinks, streaming
from clickflow.streaming.windows import _micros
from tests.conftest import rows
from workload import queries

START = datetime(2024, 1, 1)


def deliver(spark, inbox, pairs):
    """(minute, key) pairs as timed rows."""
    data = [(START + timedelta(minutes=m), k) for m, k in pairs]
    df = spark.createDataFrame(data, "ts timestamp, key string").coalesce(1)
    df.write.mode("append").parquet(inbox)


@pytest.fixture
def dirs(tmp_path):
    return tuple(str(tmp_path / n) for n in ("in", "chk", "out"))


def plain_windows(pairs, length, slide):
    found = {}
    for minute, key in pairs:
        first = (minute - length) // slide + 1
        for w in range(first * slide, minute + 1, slide):
            found[w, w + length, key] = found.get((w, w + length, key), 0) + 1
    return found


@pytest.mark.parametrize(("length", "slide"), [(60, 20), (50, 20), (30, 30)])
def test_panes_give_the_windows(spark, dirs, length, slide):
    inbox, checkpoint, out = dirs
    pairs = [(m, "ab"[m * 7 % 3 % 2]) for m in range(0, 300, 7)]
    half = len(pairs) // 2
    for part in (pairs[:half], pairs[half:], [(100_000, "end")]):
        deliver(spark, inbox, part)
        events = streaming.parquet_rows(spark, inbox)
        counts = streaming.window_count_panes(events, "ts", "key", f"{length} minutes", f"{slide} minutes", "10 minutes")
        streaming.run(counts, checkpoint, sinks.batch_files(out), output_mode="append")
    minutes = [((F.unix_seconds(c) - int((START - datetime(1970, 1, 1)).total_seconds())) / 60).cast("int") for c in ("window_start", "window_end")]
    got = sinks.read_batches(spark, out).select(*minutes, "key", "cnt").collect()
    assert len(got) == len({tuple(r)[:3] for r in got})  # each window is written once
    assert {tuple(r)[:3]: r.cnt for r in got} == plain_windows(pairs, length, slide)


def test_a_row_meets_its_pane_alone(spark, dirs):
    inbox, _, _ = dirs
    deliver(spark, inbox, [(0, "a")])
    static = spark.read.parquet(inbox)
    plan = streaming.window_count_panes(static, "ts", "key", "12 hours", "1 hour", "0 seconds")._jdf.queryExecution().optimizedPlan().toString()
    # The only Expand stands above the first aggregate.
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("Aggregate")


def test_late_rows_are_dropped_by_panes(spark, dirs):
    inbox, checkpoint, out = dirs
    for part in ([(0, "a"), (100, "a")], [(5, "late"), (100, "b")], [(10_000, "end")]):
        deliver(spark, inbox, part)
        counts = streaming.window_count_panes(streaming.parquet_rows(spark, inbox), "ts", "key", "20 minutes", "10 minutes", "1 minute")
        streaming.run(counts, checkpoint, sinks.batch_files(out), output_mode="append")
    assert {r.key for r in sinks.read_batches(spark, out).select("key").collect()} == {"a", "b"}


def test_interval_lengths(spark):
    assert _micros(spark, "2 days") == 2 * 86_400_000_000
    assert _micros(spark, "90 seconds") == 90_000_000
    with pytest.raises(ValueError, match="fixed length"):
        _micros(spark, "1 month")


def words_df(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_arrival_windows_and_replay(spark, tmp_path):
    path = str(tmp_path / "w")
    sink = streaming.arrival_windows(path, "word", length=3, slide=2)
    for batch_id, words in enumerate(["ab", "a", "", "bc", "a", "c"]):
        sink(words_df(spark, words), batch_id)
        sink(words_df(spark, words), batch_id)  # a batch that runs again
    expected = [(0, 1, "a", 2), (0, 1, "b", 1), (1, 3, "a", 1), (1, 3, "b", 1), (1, 3, "c", 1),
                (3, 5, "a", 1), (3, 5, "b", 1), (3, 5, "c", 2)]
    assert rows(streaming.read_arrival_windows(spark, path)) == expected
    # Panes that no window needs any more are gone.
    assert sorted(p.name for p in (tmp_path / "w" / "panes").glob("batch_id=*")) == ["batch_id=3", "batch_id=4", "batch_id=5"]
    with pytest.raises(ValueError, match="at least one"):
        streaming.arrival_windows(path, "word", 0, 1)


def highest(values, old):
    """The longest word so far; the word ``forget`` ends the state."""
    best = old or ""
    for value in values:
        if value == "forget":
            return None
        best = max(best, value, key=len)
    return best


def states(spark, out):
    found = sinks.read_batches(spark, out)
    return rows(found.select("batch_id", *[c for c in found.columns if c not in ("batch_id", "batch_time")]))


def test_state_of_another_kind_over_a_restart(spark, dirs):
    inbox, checkpoint, out = dirs
    for part in ([("x", "aa"), ("x", "b"), ("y", "c")], [("x", "cccc"), ("y", "forget")], [("y", "d"), (None, "n")]):
        spark.createDataFrame(part, "key string, word string").write.mode("append").parquet(inbox)
        found = streaming.running_state(streaming.parquet_rows(spark, inbox), "key", "word", highest, kind="string")
        streaming.run(found, checkpoint, sinks.batch_files(out), output_mode="update", state_partitions=2)
    assert states(spark, out) == [
        (0, "x", "aa", False), (0, "y", "c", False), (1, "x", "cccc", False), (2, "y", "d", False), (2, None, "n", False),
    ]


def test_idle_keys_expire_and_start_again(spark, dirs):
    inbox, checkpoint, out = dirs
    for part in ([(0, "a"), (0, "a"), (55, "b")], [(70, "b"), (110, "c")], [(120, "a"), (500, "end")]):
        deliver(spark, inbox, part)
        found = streaming.running_state(
            streaming.parquet_rows(spark, inbox), "key", "key", streaming.add_count, ts="ts", idle="50 minutes"
        )
        streaming.run(found, checkpoint, sinks.batch_files(out), output_mode="update", state_partitions=2)
    got = [r[1:] for r in states(spark, out)]
    assert sorted(got) == sorted([
        ("a", 2, False), ("b", 1, False), ("a", 2, True), ("b", 2, False), ("c", 1, False),
        ("a", 1, False), ("end", 1, False), ("a", 1, True), ("b", 2, True), ("c", 1, True),
    ])
    with pytest.raises(ValueError, match="go together"):
        streaming.running_state(spark.range(1), "id", "id", streaming.add_count, ts="id")


def test_own_state_runs_where_the_session_keeps_the_default_store(spark, dirs):
    inbox, checkpoint, out = dirs
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.unset(setting)  # as a session without settings has it: the HDFS store, which transformWithState refuses
    try:
        for part in ([(0, "a"), (0, "a"), (55, "b")], [(120, "a")]):
            deliver(spark, inbox, part)
            found = streaming.running_state(
                streaming.parquet_rows(spark, inbox), "key", "key", streaming.add_count, ts="ts", idle="50 minutes"
            )
            streaming.run(
                found, checkpoint, sinks.batch_files(out), output_mode="update", state_partitions=2,
                state_store=streaming.ROCKSDB,
            )
    finally:
        spark.conf.set(setting, before)
    assert sorted(r[1:] for r in states(spark, out)) == sorted([
        ("a", 2, False), ("b", 1, False), ("a", 2, True), ("b", 1, True), ("a", 1, False),
    ])


def test_many_rocksdb_stores_share_bounded_memory(spark, dirs):
    inbox, checkpoint, _ = dirs
    deliver(spark, inbox, [(0, "a")])
    prefix = "spark.sql.streaming.stateStore.rocksdb"
    found = {}

    def sink(batch, batch_id):
        for name in ("boundedMemoryUsage", "allowFAllocate"):
            found[name] = batch.sparkSession.conf.get(f"{prefix}.{name}", None)
        batch.collect()

    counts = streaming.parquet_rows(spark, inbox).groupBy("key").count()
    assert streaming.run(counts, checkpoint, sink, output_mode="update", state_partitions=2, state_store=streaming.ROCKSDB)
    assert found == {"boundedMemoryUsage": "true", "allowFAllocate": "false"}
    assert spark.conf.get(f"{prefix}.boundedMemoryUsage", None) is None


@pytest.mark.parametrize("name", ["stream_window_words", "stream_window_panes"])
def test_word_windows_keep_their_state_out_of_the_heap(spark, tmp_path, monkeypatch, name):
    stores = []
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    def stopped(*args, state_store=None, **options):
        stores.append(state_store)
        raise InterruptedError

    monkeypatch.setattr(queries.streaming, "run", stopped)
    with pytest.raises(InterruptedError):
        queries.QUERIES[name](spark, str(tmp_path))
    assert stores == [streaming.ROCKSDB]


def test_state_is_redealt(spark, dirs, tmp_path):
    inbox, checkpoint, out = dirs
    new, counts = str(tmp_path / "chk2"), str(tmp_path / "counts")
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a é%.txt").write_text("a b\na\n")
    sink = sinks.batch_files(out)
    running = streaming.running_word_count(streaming.file_lines(spark, inbox))
    streaming.run(running, checkpoint, sink, output_mode="update", state_partitions=4)
    assert rows(streaming.read_counts(spark, checkpoint)) == [("a", 2), ("b", 1)]
    streaming.read_counts(spark, checkpoint).write.parquet(counts)
    for name, text, expected in (("2.txt", "b c\n", [("a", 2), ("b", 2), ("c", 1)]), ("3.txt", "c\n", [("a", 2), ("b", 2), ("c", 2)])):
        (folder / name).write_text(text)
        lines = streaming.resumed_file_lines(spark, inbox, checkpoint)
        streaming.run(streaming.redealt_word_count(lines, counts), new, sink, output_mode="update", state_partitions=16)
        assert rows(streaming.read_counts(spark, new)) == expected
    assert streaming.state_partition_count(spark, checkpoint) == 4
    assert streaming.state_partition_count(spark, new) == 16
    assert streaming.seen_files(spark, checkpoint).count() == 1
