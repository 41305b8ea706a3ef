"""Four reports on an access log, as DataFrame and as SQL over a named table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.topk import top_by

# Sizes may be close to 2^63, so they are summed as decimals. The average is an integer division.
_SIZE_SUM = "sum(cast(contentSize as decimal(28, 0)))"
_SIZE_STATS = {
    "avg_size": f"cast({_SIZE_SUM} div nullif(count(*), 0) as bigint)",
    "min_size": "min(contentSize)",
    "max_size": "max(contentSize)",
    "total_size": _SIZE_SUM,
    "cnt": "count(*)",
}


def content_size_stats(logs: DataFrame) -> DataFrame:
    """Average, lowest and highest size, total (a decimal) and count: one row, also for an empty log."""
    return logs.agg(*[F.expr(text).alias(name) for name, text in _SIZE_STATS.items()])


def content_size_stats_sql(spark: SparkSession, view: str) -> DataFrame:
    columns = ", ".join(f"{text} AS {name}" for name, text in _SIZE_STATS.items())
    return spark.sql(f"SELECT {columns} FROM IDENTIFIER(:view)", args={"view": view})


def response_code_count(logs: DataFrame) -> DataFrame:
    return logs.groupBy("responseCode").agg(F.count(F.lit(1)).alias("cnt"))


def response_code_count_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(
        "SELECT responseCode, COUNT(*) AS cnt FROM IDENTIFIER(:view) GROUP BY responseCode",
        args={"view": view},
    )


DEFAULT_N = 20


def ip_over_n(logs: DataFrame, n: int = DEFAULT_N, limit: int | None = None) -> DataFrame:
    """All addresses with more than ``n`` requests; with ``limit``, the first of them by address."""
    counts = logs.groupBy("ipAddress").agg(F.count(F.lit(1)).alias("cnt"))
    over = counts.where(F.col("cnt") > n)
    return over if limit is None else over.orderBy("ipAddress").limit(limit)


def ip_over_n_sql(
    spark: SparkSession, view: str, n: int = DEFAULT_N, limit: int | None = None
) -> DataFrame:
    first = "" if limit is None else "ORDER BY ipAddress LIMIT :limit"
    return spark.sql(
        f"""
        SELECT ipAddress, COUNT(*) AS cnt
        FROM IDENTIFIER(:view)
        GROUP BY ipAddress
        HAVING cnt > :n
        {first}
        """,
        args={"view": view, "n": n} | ({} if limit is None else {"limit": limit}),
    )


def top_endpoints(logs: DataFrame, k: int = 5) -> DataFrame:
    counts = logs.groupBy("endpoint").agg(F.count(F.lit(1)).alias("cnt"))
    return top_by(counts, "cnt", "endpoint", k)


def top_endpoints_sql(spark: SparkSession, view: str, k: int = 5) -> DataFrame:
    return spark.sql(
        """
        SELECT endpoint, COUNT(*) AS cnt
        FROM IDENTIFIER(:view)
        GROUP BY endpoint
        ORDER BY cnt DESC, endpoint
        LIMIT :k
        """,
        args={"view": view, "k": k},
    )


def log_reports(
    logs: DataFrame, n: int = DEFAULT_N, limit: int | None = None, k: int = 5
) -> dict[str, DataFrame]:
    """All four reports on one table; wrap ``logs`` in ``cached`` to parse the log only once."""
    return {
        "content_size_stats": content_size_stats(logs),
        "response_code_count": response_code_count(logs),
        "ip_over_n": ip_over_n(logs, n, limit),
        "top_endpoints": top_endpoints(logs, k),
    }
