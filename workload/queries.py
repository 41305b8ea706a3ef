"""One entry per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow import functions, operators, plans, sinks, sources, streaming
from clickflow.operators import STOP_TOKENS
from clickflow.scratch import fresh_dir
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

# The day read by the partition scan, the threshold of the address report.
DAY = "2024-01-15"
MANY_REQUESTS = 55


_FIXTURES: dict[tuple[str, str, str], str] = {}


def _fixture(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """A derived input, written once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FIXTURES:
        path = fresh_dir(spark, name)
        write(path)
        _FIXTURES[key] = path
    return _FIXTURES[key]


# --- scans ------------------------------------------------------------------------------------


def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        inputs.document_lines(spark, sf_dir).write.text(path)

    return sources.text_lines(spark, _fixture(spark, sf_dir, "text", write))


def scan_partition_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        inputs.dated_page_view_lines(spark, sf_dir).write.partitionBy("day").text(path)

    return sources.text_partition(spark, _fixture(spark, sf_dir, "by-day", write), "day", DAY)


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        F.col("l_linenumber").alias("position"),
    )


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        _ratings(spark, sf_dir).write.option("header", True).csv(path)

    path = _fixture(spark, sf_dir, "csv", write)
    # Inference takes the narrowest type that fits the data at hand.
    return sources.csv_table(spark, path).select(
        F.col("user_id").cast("bigint"),
        F.col("item_id").cast("bigint"),
        F.col("rating").cast("double"),
        F.col("position").cast("bigint"),
    )


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        inputs.table(spark, sf_dir, "customer").write.json(path)

    rows = sources.json_table(spark, _fixture(spark, sf_dir, "json", write))
    kinds = dict(inputs.table(spark, sf_dir, "customer").dtypes)
    return rows.select(*[F.col(c).cast(kind) for c, kind in kinds.items()])


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.parquet_table(spark, f"{sf_dir}/supplier.parquet")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.row_count(inputs.table(spark, sf_dir, "lineitem"))


def scan_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.page_views(inputs.page_view_lines(spark, sf_dir))


def scan_track_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.track_log(inputs.track_lines(spark, sf_dir))


def scan_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.access_log(inputs.log_lines(spark, sf_dir))


def log_valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.valid_log_lines(inputs.log_lines(spark, sf_dir))


def log_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read, valid and rejected, counted while the size statistics are computed."""
    logs, counted = sources.counted_access_log(inputs.log_lines(spark, sf_dir))
    stats = plans.content_size_stats(logs).select("total_size").first()
    counts = counted.get
    row = (*[counts[name] for name in ("read", "valid", "rejected")], stats["total_size"])
    return spark.createDataFrame([row], "read bigint, valid bigint, rejected bigint, total_size decimal(38,0)")


def log_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are no valid log lines, written beside the valid ones in one pass."""
    return sources.split_access_log(inputs.log_lines(spark, sf_dir), fresh_dir(spark, "split-log")).rejects


# --- words ------------------------------------------------------------------------------------


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.words(inputs.document_lines(spark, sf_dir))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.word_count(words(spark, sf_dir))


def word_count_stop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        inputs.spaced_lines(spark, sf_dir).write.text(path)

    spaced = operators.words(sources.text_lines(spark, _fixture(spark, sf_dir, "spaced-text", write)))
    return operators.word_count(operators.drop_stop(spaced, STOP_TOKENS))


def word_count_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stop table small enough to be sent drops words where they are read, before the count; a larger
    # one is joined behind the count, with each word once.
    stop = inputs.stop_table(spark, sf_dir)
    return operators.drop_stop(word_count(spark, sf_dir), stop, salt=0)


def word_count_stop_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = inputs.stop_table(spark, sf_dir)
    return operators.drop_stop(word_count(spark, sf_dir), stop, salt=0, max_bytes=0)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.top_by(word_count(spark, sf_dir), "cnt", "word", 3)


def kafka_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = streaming.decode_values(inputs.kafka_records(spark, sf_dir))
    return operators.word_count(operators.words(lines))


# --- access-log reports -----------------------------------------------------------------------


def _log_view(spark: SparkSession, sf_dir: str) -> str:
    operators.register(scan_access_log(spark, sf_dir), "access_log")
    return "access_log"


def content_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.content_size_stats(scan_access_log(spark, sf_dir))


def content_size_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.content_size_stats_sql(spark, _log_view(spark, sf_dir))


def response_code_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.response_code_count(scan_access_log(spark, sf_dir))


def response_code_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.response_code_count_sql(spark, _log_view(spark, sf_dir))


def ip_over_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ip_over_n(scan_access_log(spark, sf_dir), n=MANY_REQUESTS)


def ip_over_n_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ip_over_n_sql(spark, _log_view(spark, sf_dir), n=MANY_REQUESTS)


def top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_endpoints(scan_access_log(spark, sf_dir))


def top_endpoints_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_endpoints_sql(spark, _log_view(spark, sf_dir))


# --- traffic and sessions ---------------------------------------------------------------------


def daily_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_pv(scan_track_log(spark, sf_dir))


def daily_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.daily_uv(scan_track_log(spark, sf_dir))


def distinct_day_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.distinct_day_guid(scan_track_log(spark, sf_dir))


def pv_join_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.pv_join_uv(scan_track_log(spark, sf_dir))


def pv_union_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.pv_union_uv(scan_track_log(spark, sf_dir))


def session_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.session_top(scan_page_views(spark, sf_dir))


def session_top10_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    operators.register(scan_page_views(spark, sf_dir), "page_views")
    return plans.session_top_sql(spark, "page_views")


def select_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    functions.register_functions(spark)
    return scan_page_views(spark, sf_dir).selectExpr("session_id", "toUpper(session_id) AS uuid")


def select_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    functions.register_functions(spark)
    return inputs.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "toLower(c_mktsegment) AS segment"
    )


# --- joins ------------------------------------------------------------------------------------


def emp_dept_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    emp = sources.emp_table(inputs.emp_lines(spark, sf_dir))
    dept = sources.dept_table(inputs.dept_lines(spark, sf_dir))
    return operators.dim_join(emp, dept, "deptno")


def emp_dept_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key of more than ten rows is spread before the one shuffle of the employees."""
    emp = sources.emp_table(inputs.emp_lines(spark, sf_dir))
    dept = sources.dept_table(inputs.dept_lines(spark, sf_dir))
    return operators.dim_join(emp, dept, "deptno", strategy="merge", salt=8, hot_rows=10)


def heavy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The return flags of all line items with their counts: fewer keys than are tracked, so counts are exact."""
    found = operators.heavy_keys(inputs.table(spark, sf_dir, "lineitem"), F.xxhash64("l_returnflag"))
    pairs = spark.createDataFrame(list(zip(found.hashes, found.estimates, strict=True)), "hash bigint, cnt bigint")
    flags = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    return flags.join(pairs, F.xxhash64("l_returnflag") == F.col("hash")).select("l_returnflag", "cnt")


def emp_dept_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    emp = sources.emp_table(inputs.emp_lines(spark, sf_dir))
    dept = sources.dept_table(inputs.dept_lines(spark, sf_dir))
    return operators.dim_lookup(emp, dept, "deptno")


# --- per-group top-k, sel_max -----------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.group_pairs(inputs.pair_lines(spark, sf_dir))


def group_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.group_top(_pairs(spark, sf_dir), "key", "value")


def group_top3_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.group_top(_pairs(spark, sf_dir), "key", "value", salt=8)


def group_top3_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.group_top_selected(_pairs(spark, sf_dir), "key", "value")


def group_top3_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = operators.group_top_list(_pairs(spark, sf_dir), "key", "value")
    return listed.select("key", F.array_join("top_values", ",").alias("top_values"))


def sel_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.table(spark, sf_dir, "customer")
    return customers.groupBy("c_mktsegment").agg(
        functions.sel_max("c_acctbal").alias("highest"),
        functions.sel_max(F.col("c_acctbal") - 20000).alias("all_negative"),
    )


def sel_max_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    operators.register(inputs.table(spark, sf_dir, "customer"), "salaries")
    highest, negative, falling = (
        functions.sel_max_sql(e) for e in ("c_acctbal", "c_acctbal - 20000", "-c_acctbal")
    )
    return spark.sql(
        f"SELECT c_mktsegment, {highest} AS highest, {negative} AS all_negative, {falling} AS falling, "
        "COUNT(*) AS cnt FROM salaries GROUP BY c_mktsegment"
    )


def sel_max_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sel_max`` by its name, twice in one statement and beside built-in aggregates."""
    functions.register_aggregate(spark, functions.SEL_MAX)
    operators.register(inputs.table(spark, sf_dir, "customer"), "salaries")
    return spark.sql(
        "SELECT c_mktsegment, sel_max(c_acctbal) AS highest, sel_max(c_acctbal - 20000) AS all_negative, "
        "sel_max(-c_acctbal) AS falling, COUNT(*) AS cnt FROM salaries GROUP BY c_mktsegment"
    )


# --- sinks ------------------------------------------------------------------------------------


def _event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_type")
    return operators.word_count(events, "event_type")


def sink_text_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "tsv")
    sinks.write_tsv(word_count(spark, sf_dir), path)
    return sources.text_lines(spark, path)


def sink_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write to a table and read it back.

    The database is Derby, embedded in the process. It is seen by that process only, so this entry
    works on a local session and not on a cluster.
    """
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("an embedded database is not visible to the executors of a cluster")
    url = f"jdbc:derby:;databaseName={mkdtemp(prefix='clickflow-')}/db;create=true"
    sinks.write_jdbc(_event_counts(spark, sf_dir), url, "event_counts")
    return spark.read.jdbc(url, "event_counts")


def sink_jdbc_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a staging table and one transaction, written twice: the second run replaces the first."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("an embedded database is not visible to the executors of a cluster")
    url = f"jdbc:derby:;databaseName={mkdtemp(prefix='clickflow-')}/db;create=true"
    for mode in ("error", "overwrite"):
        sinks.write_jdbc_once(_event_counts(spark, sf_dir), url, "event_counts", mode=mode)
    return spark.read.jdbc(url, "event_counts")


# --- streams ----------------------------------------------------------------------------------


def _two_deliveries(
    spark: SparkSession, sf_dir: str, run: Callable[[DataFrame, str], object]
) -> None:
    """Deliver the document lines in two lots; run the stream after each, from one checkpoint."""
    inbox, checkpoint = fresh_dir(spark, "inbox"), fresh_dir(spark, "checkpoint")
    for lines in inputs.document_deliveries(spark, sf_dir):
        lines.write.mode("append").text(inbox)
        run(streaming.file_lines(spark, inbox), checkpoint)


def stream_batch_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "batches")
    sink = streaming.batch_word_count(sinks.batch_files(out))
    _two_deliveries(spark, sf_dir, lambda lines, chk: streaming.run(lines, chk, sink))
    return sinks.read_batches(spark, out).select("batch_id", "word", "cnt")


def sink_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count of each delivery under a commit log; the last batch runs twice."""
    out = fresh_dir(spark, "logged")
    sink = streaming.batch_word_count(sinks.logged_batches(out))

    def twice(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if batch_id == 1:
            sink(batch, batch_id)

    _two_deliveries(spark, sf_dir, lambda lines, chk: streaming.run(lines, chk, twice))
    return sinks.read_logged(spark, out).select("batch_id", "word", "cnt")


def sink_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "lines")
    sink = sinks.batch_files(out, fmt="json")

    def run(lines: DataFrame, checkpoint: str) -> None:
        streaming.run(sinks.with_batch_time(lines), checkpoint, sink)

    _two_deliveries(spark, sf_dir, run)
    written = sinks.read_batches(spark, out, fmt="json", schema="value string, batch_time string")
    # The time itself differs from run to run.
    return written.select("batch_id", "value", F.length("batch_time").alias("time_length"))


def sink_batch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count of each delivery as text lines."""
    out = fresh_dir(spark, "batch-text")
    sink = streaming.batch_word_count(sinks.batch_tsv(out))
    _two_deliveries(spark, sf_dir, lambda lines, chk: streaming.run(lines, chk, sink))
    return sinks.read_batches(spark, out, fmt="text", schema="value string").select("batch_id", "value")


def _running(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    out = fresh_dir(spark, "running")
    sink = sinks.batch_files(out)

    def run(lines: DataFrame, checkpoint: str) -> None:
        streaming.run(streaming.running_word_count(lines), checkpoint, sink, output_mode=mode)

    _two_deliveries(spark, sf_dir, run)
    return sinks.read_batches(spark, out).select("batch_id", "word", "cnt")


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word in every batch, continued over a restart."""
    return _running(spark, sf_dir, "complete")


def stream_restart_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only changed words in each batch, continued over a restart."""
    return _running(spark, sf_dir, "update")


def _latest_windows(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The last count of each window that was written in update mode."""
    found = sinks.read_batches(spark, out)
    last = found.groupBy("window_start", "window_end", key).agg(F.max_by("cnt", "batch_id").alias("cnt"))
    return last.select(
        F.unix_seconds("window_start").alias("window_start"),
        F.unix_seconds("window_end").alias("window_end"),
        key,
        "cnt",
    )


def stream_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = fresh_dir(spark, "windows"), fresh_dir(spark, "checkpoint")
    events = streaming.parquet_rows(spark, f"{sf_dir}/events.parquet")
    # The column has no time zone; it is read as UTC whatever the zone of the session.
    utc = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    timed = events.select("event_type", utc.alias("ts"))
    counts = streaming.window_count(timed, "ts", "event_type", "12 hours", "6 hours", "10 minutes")
    streaming.run(counts, checkpoint, sinks.batch_files(out), output_mode="update")
    return _latest_windows(spark, out, "event_type")


def stream_window_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of timed records in sliding windows, in two deliveries over a restart."""
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "windows", "checkpoint"))
    for records in inputs.timed_deliveries(spark, sf_dir):
        records.write.mode("append").parquet(inbox)
        lines = streaming.decode_values(streaming.parquet_rows(spark, inbox), keep=["timestamp"])
        # The deliveries overlap in time, so nothing may be late.
        counts = streaming.window_word_count(
            lines, "timestamp", "2 days", "1 day", watermark="100000 days"
        )
        streaming.run(
            counts, checkpoint, sinks.batch_files(out), output_mode="update", state_store=streaming.ROCKSDB
        )
    return _latest_windows(spark, out, "word")


def stream_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from panes of a day: written once, when they are final."""
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "windows", "checkpoint"))
    for records in (*inputs.timed_deliveries(spark, sf_dir), inputs.closing_record(spark)):
        records.write.mode("append").parquet(inbox)
        lines = streaming.decode_values(streaming.parquet_rows(spark, inbox), keep=["timestamp"])
        counts = streaming.window_word_count_panes(
            lines, "timestamp", "2 days", "1 day", watermark="100000 days"
        )
        streaming.run(
            counts, checkpoint, sinks.batch_files(out), output_mode="append", state_store=streaming.ROCKSDB
        )
    return sinks.read_batches(spark, out).select(
        F.unix_seconds("window_start").alias("window_start"),
        F.unix_seconds("window_end").alias("window_end"),
        "word",
        "cnt",
    )


def stream_window_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the last three batches, after every second one; the stream is restarted for each batch."""
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "arrivals", "checkpoint"))
    sink = streaming.each_batch(operators.words, streaming.arrival_windows(out, "word", length=3, slide=2))
    for lines in inputs.language_deliveries(spark, sf_dir):
        lines.write.mode("append").text(inbox)
        streaming.run(streaming.file_lines(spark, inbox), checkpoint, sink)
    return streaming.read_arrival_windows(spark, out)


def stream_state_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per visit of a user, by a function of one's own; a visit ends after twelve idle hours.

    Three deliveries, each over a restart. Every batch gives the users it changed and the visits that have ended.
    """
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "states", "checkpoint"))
    for events in inputs.event_deliveries(spark, sf_dir):
        events.write.mode("append").parquet(inbox)
        counts = streaming.running_state(
            streaming.parquet_rows(spark, inbox), "user_id", "event_type", streaming.add_count, ts="ts", idle="12 hours"
        )
        streaming.run(
            counts, checkpoint, sinks.batch_files(out), output_mode="update", state_partitions=4,
            state_store=streaming.ROCKSDB,
        )
    return sinks.read_batches(spark, out).select("user_id", F.col("state").alias("cnt"), "expired")


def stream_redealt_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running count over both deliveries, the second with four times as many state partitions.

    The result is read from the state, as the first counts are.
    """
    inbox, first, counts, second = (fresh_dir(spark, n) for n in ("inbox", "checkpoint", "counts", "checkpoint"))
    english, others = inputs.document_deliveries(spark, sf_dir)
    english.write.text(inbox)
    running = streaming.running_word_count(streaming.file_lines(spark, inbox))
    sink = sinks.batch_files(fresh_dir(spark, "running"))
    streaming.run(running, first, sink, output_mode="update", state_partitions=4)
    streaming.read_counts(spark, first).write.parquet(counts)

    others.write.mode("append").text(inbox)
    going_on = streaming.redealt_word_count(streaming.resumed_file_lines(spark, inbox, first), counts)
    sink = sinks.batch_files(fresh_dir(spark, "running"))
    streaming.run(going_on, second, sink, output_mode="update", state_partitions=16)
    return streaming.read_counts(spark, second)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_text,
        scan_partition_dir,
        scan_csv,
        scan_json,
        scan_parquet,
        row_count,
        scan_page_views,
        scan_track_log,
        scan_access_log,
        log_valid_lines,
        log_line_counts,
        log_rejected_lines,
        words,
        word_count,
        word_count_stop_list,
        word_count_stop_table,
        word_count_stop_shuffled,
        top_words,
        kafka_word_count,
        content_size_stats,
        content_size_stats_sql,
        response_code_count,
        response_code_count_sql,
        ip_over_n,
        ip_over_n_sql,
        top_endpoints,
        top_endpoints_sql,
        daily_pv,
        daily_uv,
        distinct_day_guid,
        pv_join_uv,
        pv_union_uv,
        session_top10,
        session_top10_sql,
        select_upper,
        select_lower,
        emp_dept_join,
        emp_dept_join_shuffled,
        emp_dept_lookup,
        heavy_keys,
        group_top3,
        group_top3_salted,
        group_top3_selected,
        group_top3_list,
        sel_max,
        sel_max_sql,
        sel_max_named,
        sink_text_tsv,
        sink_jdbc,
        sink_jdbc_once,
        sink_batch_log,
        stream_batch_word_count,
        sink_batch_files,
        sink_batch_text,
        stream_running_count,
        stream_restart_count,
        stream_window_count,
        stream_window_words,
        stream_window_panes,
        stream_window_arrival,
        stream_state_count,
        stream_redealt_count,
    )
}
