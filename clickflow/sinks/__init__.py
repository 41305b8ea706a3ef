from clickflow.sinks.files import batch_files, batch_tsv, read_batches, with_batch_time, write_tsv
from clickflow.sinks.jdbc import batch_jdbc, write_jdbc
from clickflow.sinks.logged import commits, delete_replaced, logged_batches, read_logged
from clickflow.sinks.staged import batch_jdbc_once, run_in_transaction, write_jdbc_once

__all__ = [
    "batch_files",
    "batch_jdbc",
    "batch_jdbc_once",
    "batch_tsv",
    "commits",
    "delete_replaced",
    "logged_batches",
    "read_batches",
    "read_logged",
    "run_in_transaction",
    "with_batch_time",
    "write_jdbc",
    "write_jdbc_once",
    "write_tsv",
]
