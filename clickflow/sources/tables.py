"""The tab-separated record layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.checks import keep_or_raise
from clickflow.operators.predicates import non_blank
from clickflow.sources.delimited import OnShort, positional_table

# Field positions of the record layouts.
PAGE_VIEW_FIELDS = [
    ("track_time", 0),
    ("url", 1),
    ("session_id", 2),
    ("referer", 3),
    ("ip", 4),
    ("end_user_id", 5),
    ("city_id", 6),
]
TRACK_FIELDS = [("track_time", 17), ("url", 1), ("guid", 5)]
EMP_FIELDS = [("deptno", 7), ("ename", 1)]
DEPT_FIELDS = [("deptno", 0), ("dname", 1)]


def page_views(lines: DataFrame, on_short: OnShort = "fail") -> DataFrame:
    return positional_table(lines, "\t", PAGE_VIEW_FIELDS, on_short)


def track_log(lines: DataFrame, on_short: OnShort = "fail") -> DataFrame:
    """(day, url, guid) of each non-blank line; day is the first ten characters of the time.

    ``on_short`` also decides about a time of fewer characters.
    """
    rows = positional_table(non_blank(lines, "value"), "\t", TRACK_FIELDS, on_short)
    has_day = F.length("track_time") >= 10
    if on_short == "fail":
        has_day = keep_or_raise(has_day, F.concat(F.lit("no day in the time "), F.col("track_time")))
    return rows.where(has_day).select(F.substring("track_time", 1, 10).alias("day"), "url", "guid")


def emp_table(lines: DataFrame, on_short: OnShort = "fail") -> DataFrame:
    return positional_table(lines, "\t", EMP_FIELDS, on_short)


def dept_table(lines: DataFrame, on_short: OnShort = "fail") -> DataFrame:
    return positional_table(lines, "\t", DEPT_FIELDS, on_short)
