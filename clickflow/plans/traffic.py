"""Daily page views (PV) and unique visitors (UV) of a track log (day, url, guid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.predicates import is_non_blank, non_blank


def daily_pv(track: DataFrame) -> DataFrame:
    """Rows per day whose url is not blank."""
    return non_blank(track, "url").groupBy("day").agg(F.count(F.lit(1)).alias("pv"))


def distinct_day_guid(track: DataFrame) -> DataFrame:
    return track.select("day", "guid").distinct()


def daily_uv(track: DataFrame) -> DataFrame:
    """Distinct visitors per day. The empty guid is one visitor; the url does not matter.

    Spark plans this as distinct (day, guid) pairs first and the count per day after, so a day or
    a visitor with most of the rows is spread over tasks.
    """
    return track.groupBy("day").agg(F.count_distinct("guid").alias("uv"))


def _daily_both(track: DataFrame) -> DataFrame:
    """PV and UV of each day from one pass over the log. PV may be 0 here."""
    return track.groupBy("day").agg(
        F.count_if(is_non_blank("url")).alias("pv"), F.count_distinct("guid").alias("uv")
    )


def pv_join_uv(track: DataFrame) -> DataFrame:
    """(day, pv, uv): the inner join by day of both aggregates.

    Both have one row per day and every day with page views has visitors, so the join equals one
    aggregation that leaves out the days without page views. It reads and parses the log once.
    """
    return _daily_both(track).where(F.col("pv") > 0)


def pv_union_uv(track: DataFrame, with_metric: bool = False) -> DataFrame:
    """(day, n): the bag union of both aggregates, again from one pass over the log.

    ``with_metric`` adds a column that tells the two kinds of rows apart.
    """
    both = _daily_both(track).select(
        "day",
        F.explode(
            F.array(
                F.struct(F.lit("pv").alias("metric"), F.col("pv").alias("n")),
                F.struct(F.lit("uv").alias("metric"), F.col("uv").alias("n")),
            )
        ).alias("row"),
    )
    rows = both.select("day", "row.metric", "row.n").where("metric = 'uv' or n > 0")
    return rows if with_metric else rows.drop("metric")
