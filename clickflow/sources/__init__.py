from clickflow.sources.access_log import SplitLog, access_log, counted_access_log, split_access_log, valid_log_lines
from clickflow.sources.delimited import group_pairs, positional_table
from clickflow.sources.files import csv_table, json_table, parquet_table, text_lines, text_partition
from clickflow.sources.tables import dept_table, emp_table, page_views, track_log

__all__ = [
    "SplitLog",
    "access_log",
    "counted_access_log",
    "csv_table",
    "dept_table",
    "emp_table",
    "group_pairs",
    "json_table",
    "page_views",
    "parquet_table",
    "positional_table",
    "split_access_log",
    "text_lines",
    "text_partition",
    "track_log",
    "valid_log_lines",
]
