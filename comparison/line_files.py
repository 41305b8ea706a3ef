"""Write the raw line inputs to text files, for jobs that start from files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickflow.scratch import fresh_dir
from workload import inputs

LINES = {
    "documents": inputs.document_lines,
    "access_log": inputs.log_lines,
    "track_log": inputs.track_lines,
    "pairs": inputs.pair_lines,
}


def write(spark: SparkSession, sf_dir: str, copies: int = 1) -> dict[str, str]:
    """Name -> path. ``copies`` repeats every line, for runs long enough to compare."""
    root = fresh_dir(spark, "lines")
    paths = {}
    for name, build in LINES.items():
        paths[name] = f"{root}/{name}"
        lines = build(spark, sf_dir)
        for _ in range(copies):
            lines.write.mode("append").text(paths[name])
    return paths
