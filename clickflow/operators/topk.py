"""Global and per-group top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from clickflow.operators.salting import SALT
from clickflow.operators.sizes import DEFAULT_BROADCAST_BYTES, if_small
from clickflow.scratch import fresh_dir


def top_by(df: DataFrame, count_col: str, key_col: str, k: int) -> DataFrame:
    """The k rows with the highest count; equal counts go by key."""
    return df.orderBy(F.desc(count_col), F.asc(key_col)).limit(k)


def _ranked(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    by_value = Window.partitionBy(*keys).orderBy(F.desc(value))
    return df.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= k)


def group_top(df: DataFrame, key: str, value: str, k: int = 3, salt: int = 0) -> DataFrame:
    """(key, value, rank) of the k highest values per key; equal values all count, nulls do not.

    Equal rows are counted before the shuffle, so a key with few different values brings few rows. Spark
    then cuts every task to k rows per key while k is within its own limit (1,000 unless set).
    ``salt=N`` first takes the k highest different values of N parts of each key, which is exact because the
    top k of a key are among those of its parts; choose it for a hot key with a k beyond that limit.
    """
    rows = df.select(key, value).where(F.col(value).isNotNull())
    counted = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    if salt > 1:
        part = F.pmod(F.xxhash64(value), F.lit(salt)).cast("int")
        counted = _ranked(counted.withColumn(SALT, part), [key, SALT], value, k).drop(SALT, "rank")
    highest = _ranked(counted, [key], value, k)
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(k)).cast("int")))
    return _ranked(highest.select(key, value, copies.alias("_copy")).drop("_copy"), [key], value, k)


#: Gaps below a key's highest value are told apart by a sixteenth of their logarithm.
_GAP_STEPS = 16


def _gap(value: Column, highest: Column) -> Column:
    """A number that does not fall as ``value`` does: 0 at the highest one, then steps of the gap's logarithm.

    Infinite values and NaN, which is above all, count as the highest.
    """
    as_double = value.cast("double")
    gap = highest - as_double
    steps = F.floor(F.log(gap) * _GAP_STEPS).cast("bigint") + 20_000
    finite = ~F.isnan(as_double) & (F.abs(as_double) < float("inf"))
    lowest = as_double == float("-inf")
    return F.when(lowest, 1 << 40).when(~finite | (gap <= 0), 0).when(gap < float("inf"), steps).otherwise(1 << 39)


def group_top_selected(
    df: DataFrame, key: str, value: str, k: int = 3, max_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """``group_top`` of a numeric column without sorting all rows.

    A first pass takes the highest value of each key, a second one a histogram of the gaps below it, in steps that
    widen with the gap. Both combine before the shuffle. The step in which the k-th value lies is the key's
    threshold; only rows at or above it, little more than k of them unless many are equal, are counted and ranked. The
    table is read three times: worth it where reading is cheap and sorting is not. Thresholds are broadcast up to ``max_bytes``;
    with so many keys that they are larger, this is ``group_top``.
    """
    if not isinstance(df.schema[value].dataType, NumericType):
        raise ValueError(f"{value} must be numeric")
    rows = df.select(F.col(key), F.col(value)).where(F.col(value).isNotNull())
    as_double = F.col(value).cast("double")
    finite = F.when(~F.isnan(as_double) & (F.abs(as_double) < float("inf")), as_double)
    highest = _kept(rows.groupBy(key).agg(F.max(finite).alias("_highest")), "highest")
    if if_small(highest, max_bytes) is None:
        return group_top(df, key, value, k)

    def same_key(found: DataFrame) -> DataFrame:
        renamed = found.withColumnRenamed(key, "_key")
        return rows.join(F.broadcast(renamed), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")

    step = _gap(F.col(value), F.col("_highest"))
    histogram = same_key(highest).groupBy(key, step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy(key).orderBy("_step")
    reached = histogram.withColumn("_sum", F.sum("_n").over(so_far))
    last = F.coalesce(F.min(F.when(F.col("_sum") >= k, F.col("_step"))), F.max("_step")).alias("_last")
    steps = _kept(reached.groupBy(key).agg(last), "thresholds")
    thresholds = steps.join(highest.withColumnRenamed(key, "_other"), F.col(key).eqNullSafe(F.col("_other"))).drop("_other")
    wanted = same_key(thresholds.select(key, "_highest", "_last")).where(step <= F.col("_last"))
    return group_top(wanted.select(key, value), key, value, k)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """One row per key, computed once: written to the shared folder and read back."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_top_list(df: DataFrame, key: str, value: str, k: int = 3, salt: int = 0) -> DataFrame:
    """(key, top_values) with the k highest values of the key as a descending list."""
    listed = group_top(df, key, value, k, salt).groupBy(key).agg(
        F.collect_list(value).alias("top_values")
    )
    return listed.withColumn("top_values", F.sort_array("top_values", asc=False))
