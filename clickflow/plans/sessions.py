"""Sessions with the most page views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.topk import top_by


def session_top(views: DataFrame, k: int = 10) -> DataFrame:
    counts = views.groupBy("session_id").agg(F.count(F.lit(1)).alias("cnt"))
    return top_by(counts, "cnt", "session_id", k)


def session_top_sql(spark: SparkSession, view: str, k: int = 10) -> DataFrame:
    return spark.sql(
        """
        SELECT session_id, COUNT(*) AS cnt
        FROM IDENTIFIER(:view)
        GROUP BY session_id
        ORDER BY cnt DESC, session_id
        LIMIT :k
        """,
        args={"view": view, "k": k},
    )
