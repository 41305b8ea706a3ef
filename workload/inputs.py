"""Raw inputs derived from the supplied tables, over all their rows.

The supplied tables are typed; the library starts from raw lines. Each function writes a table out
in the line format that a job expects. Texts use integer arithmetic and copied columns only, so
that the oracle can compute the answer from the typed table without parsing anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import lines_of, words
from clickflow.sources import parquet_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, f"{sf_dir}/{name}.parquet")


def _lines(df: DataFrame, text: str) -> DataFrame:
    """One line per row, built once.

    A scanned line costs nothing to read twice, a computed one does. The one-element explode keeps
    the optimizer from computing it again for every column that is parsed from it.
    """
    return df.select(F.explode(F.array(F.expr(text))).alias("value"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(table(spark, sf_dir, "documents"), "text")


def document_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All document lines in two deliveries: English ones, then the others."""
    documents = table(spark, sf_dir, "documents")
    english = F.col("lang").eqNullSafe("en")
    return [lines_of(documents.where(part), "text") for part in (english, ~english)]


def spaced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines with commas, full stops and question marks set off as words of their own."""
    return document_lines(spark, sf_dir).select(
        F.regexp_replace("value", "([,.?])", " $1").alias("value")
    )


def timed_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The documents in Kafka's columns, one record each, in two deliveries. ``doc_id`` gives the minute."""
    records = table(spark, sf_dir, "documents").selectExpr(
        "cast(text as binary) as value", "timestamp_seconds(doc_id * 60) as timestamp", "lang"
    )
    english = F.col("lang").eqNullSafe("en")
    return [records.where(part).drop("lang") for part in (english, ~english)]


def language_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All document lines in five deliveries: one for each of four languages, then the rest."""
    documents = table(spark, sf_dir, "documents")
    parts = [F.col("lang") == lang for lang in ("en", "de", "es", "fr")]
    rest = F.col("lang").isNull() | ~F.col("lang").isin("en", "de", "es", "fr")
    return [lines_of(documents.where(part), "text") for part in (*parts, rest)]


#: The days on which a new delivery of ``event_deliveries`` begins.
NEW_DELIVERIES = ("2024-01-11", "2024-01-21")


def event_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All events in three deliveries, one after the other in time. ``ts`` is read as UTC whatever the session's zone."""
    utc = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    day = F.left(F.col("ts").cast("string"), F.lit(10))
    events = table(spark, sf_dir, "events")
    first, second = NEW_DELIVERIES
    parts = (day < first, (day >= first) & (day < second), day >= second)
    return [events.where(part).select("user_id", "event_type", utc.alias("ts")) for part in parts]


def closing_record(spark: SparkSession) -> DataFrame:
    """One empty record of the far future, after which every earlier window is final."""
    return spark.sql("SELECT cast('' as binary) as value, timestamp'9000-01-01 00:00:00Z' as timestamp")


def stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words to leave out: the vocabulary of the benchmark texts."""
    return words(lines_of(table(spark, sf_dir, "benchmark"), "text")).distinct()


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access-log line per event.

    Sign-ups are answered without a body, so their size is ``-`` and the line is invalid; clicks
    carry referer and agent after the size, as in the combined format.
    """
    return _lines(
        table(spark, sf_dir, "events"),
        r"""concat(
            '10.', user_id div 65536, '.', user_id div 256 % 256, '.', user_id % 256,
            ' - u', user_id, ' [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] "GET /',
            event_type, '/', regexp_extract(props, '(\\d+)', 1), ' HTTP/1.1" ',
            case event_type when 'error' then '500' else '200' end, ' ',
            case event_type when 'signup' then '-' else string(event_id * 37 % 10007) end,
            case event_type when 'click' then ' "http://shop.example/" "agent 1.0"' else '' end
        )""",
    )


def page_view_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(
        table(spark, sf_dir, "events"),
        r"""concat_ws('\t', left(string(ts), 19), concat('/', event_type), concat('s', user_id),
            '-', concat('10.0.0.', user_id % 256), user_id, user_id % 25)""",
    )


def dated_page_view_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_view_lines(spark, sf_dir).select("value", F.left("value", F.lit(10)).alias("day"))


def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 18-field line per event, and a blank line per region.

    Errors have a blank url; viewers are anonymous, with an empty guid.
    """
    visits = _lines(
        table(spark, sf_dir, "events"),
        r"""concat_ws('\t', event_id,
            case event_type when 'error' then ' ' else concat('http://shop.example/', event_type) end,
            'r', 'k', 't', case event_type when 'view' then '' else string(user_id) end,
            's', '', '', '', '', '', '', '', '', '', '', left(string(ts), 19))""",
    )
    blank = table(spark, sf_dir, "region").selectExpr("' \t ' as value")
    return visits.unionByName(blank)


def emp_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(
        table(spark, sf_dir, "customer"),
        r"concat_ws('\t', c_custkey, c_name, c_mktsegment, '', '', '', '', c_nationkey)",
    )


def dept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(table(spark, sf_dir, "nation"), r"concat_ws('\t', n_nationkey, n_name)")


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key value`` lines: return flag and part of every line item. Three hot keys."""
    return _lines(table(spark, sf_dir, "lineitem"), "concat(l_returnflag, ' ', l_partkey)")


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines in the columns of Spark's Kafka source."""
    return document_lines(spark, sf_dir).selectExpr(
        "cast(null as binary) as key",
        "cast(value as binary) as value",
        "'lines' as topic",
        "spark_partition_id() as partition",
        "monotonically_increasing_id() as offset",
        "timestamp_seconds(0) as timestamp",
        "0 as timestampType",
    )
