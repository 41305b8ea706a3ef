"""DataFrame jobs beside RDD-style jobs on the same text files, as JSON lines.

The RDD forms are written the way one would without DataFrames: rows as tuples, keys reduced by
hand. They are a yardstick only; the library does not use them.

    python -m comparison.rdd_style   # BENCH_SF_DIR, BENCH_CPUS, BENCH_COPIES
"""

from __future__ import annotations

import heapq
import json
import os
import re
import statistics
import time
from collections.abc import Callable

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession

from bench import session
from comparison import line_files
from clickflow import operators, plans, sources
from clickflow.sources.access_log import LOG_PATTERN


def jvm_words(line: str) -> list[str]:
    return line.rstrip(" ").split(" ") if line == "" or line.strip(" ") else []


def rdd_word_count(lines: RDD) -> int:
    ones = lines.flatMap(jvm_words).map(lambda word: (word, None))
    return ones.aggregateByKey(0, lambda n, _: n + 1, lambda a, b: a + b).count()


def rdd_content_size_stats(lines: RDD) -> object:
    pattern = re.compile(LOG_PATTERN, re.ASCII)
    sizes = lines.map(pattern.search).filter(bool).map(lambda m: int(m.group().rsplit(" ", 1)[1]))
    return sizes.stats()


def rdd_daily_uv(lines: RDD) -> int:
    fields = lines.filter(str.strip).map(lambda line: line.split("\t"))
    visitors = fields.map(lambda f: (f[17][:10], f[5])).distinct()
    return len(visitors.countByKey())


def rdd_group_top3(lines: RDD) -> int:
    def add(best: list[int], value: int) -> list[int]:
        return heapq.nlargest(3, [*best, value])

    def merge(a: list[int], b: list[int]) -> list[int]:
        return heapq.nlargest(3, a + b)

    pairs = lines.map(lambda line: line.split(" ")).map(lambda kv: (kv[0], int(kv[1])))
    return pairs.aggregateByKey([], add, merge).count()


def df_word_count(lines: DataFrame) -> DataFrame:
    return operators.word_count(operators.words(lines))


def df_content_size_stats(lines: DataFrame) -> DataFrame:
    return plans.content_size_stats(sources.access_log(lines))


def df_daily_uv(lines: DataFrame) -> DataFrame:
    return plans.daily_uv(sources.track_log(lines))


def df_group_top3(lines: DataFrame) -> DataFrame:
    return operators.group_top(sources.group_pairs(lines), "key", "value")


JOBS: dict[str, tuple[str, Callable, Callable]] = {
    "word_count": ("documents", df_word_count, rdd_word_count),
    "content_size_stats": ("access_log", df_content_size_stats, rdd_content_size_stats),
    "daily_uv": ("track_log", df_daily_uv, rdd_daily_uv),
    "group_top3": ("pairs", df_group_top3, rdd_group_top3),
}


def median_seconds(run: Callable[[], object], runs: int = 3) -> float:
    timings = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        run()
        timings.append(time.perf_counter() - started)
    return round(statistics.median(timings[1:]), 3)


def compare(spark: SparkSession, paths: dict[str, str]) -> None:
    for name, (source, dataframe, rdd) in JOBS.items():
        path = paths[source]
        result = {
            "query": name,
            "dataframe_sec": median_seconds(
                lambda: dataframe(sources.text_lines(spark, path))
                .write.format("noop")
                .mode("overwrite")
                .save()
            ),
            "rdd_style_sec": median_seconds(lambda: rdd(spark.sparkContext.textFile(path))),
        }
        print(json.dumps(result), flush=True)


if __name__ == "__main__":
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    compare(spark, line_files.write(spark, sf_dir, int(os.environ.get("BENCH_COPIES", "1"))))
    spark.stop()
