from clickflow.streaming.counts import (
    batch_word_count,
    running_word_count,
    window_count,
    window_word_count,
)
from clickflow.streaming.runs import ROCKSDB, run, start
from clickflow.streaming.sources import decode_values, file_lines, kafka_lines, parquet_rows
from clickflow.streaming.state import (
    add_count,
    read_counts,
    redealt_word_count,
    resumed_file_lines,
    running_state,
    seen_files,
    state_partition_count,
)
from clickflow.streaming.windows import (
    arrival_windows,
    each_batch,
    read_arrival_windows,
    window_count_panes,
    window_word_count_panes,
)

__all__ = [
    "ROCKSDB",
    "add_count",
    "arrival_windows",
    "batch_word_count",
    "decode_values",
    "each_batch",
    "file_lines",
    "kafka_lines",
    "parquet_rows",
    "read_arrival_windows",
    "read_counts",
    "redealt_word_count",
    "resumed_file_lines",
    "run",
    "running_state",
    "running_word_count",
    "seen_files",
    "start",
    "state_partition_count",
    "window_count",
    "window_count_panes",
    "window_word_count",
    "window_word_count_panes",
]
