"""Splitting hot keys.

The salt of a row is a hash of the columns that the caller names, so it is the same when a task runs again, and
rows that earlier steps gathered by key are spread as well. Rows equal in all those columns stay together.
In a join only hot keys are salted. They are found by a summary of the large side's keys that each task keeps
within a fixed size, before anything is shuffled; the small side is repeated for those keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
DEFAULT_SALT = 64
#: Keys with more rows than this on the large side are hot.
DEFAULT_HOT_ROWS = 1_000_000
#: Keys that a summary keeps track of, about 1 MB, and groups of tasks whose summaries are merged first.
TRACKED_KEYS = 65_536
_MERGERS = 256
#: Hot keys that a query names at most, and copies of a key on the small side at most.
MOST_HOT_KEYS = 10_000
#: What a summary may miss, as rows times this over the keys tracked: 3.5 over the size of its table, of which it fills 3/4.
_ERROR = 3.5 * 0.75


def row_salt(salt: int, columns: Sequence[str]) -> Column:
    """0 to ``salt - 1`` by the hash of these columns."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(salt)).cast("int")


@dataclass(frozen=True)
class HeavyKeys:
    """``hashes``: of the keys found, the most frequent first, with ``estimates`` of their rows.

    Each estimate is above the true count by ``error`` at most, and no key with more rows than ``error`` is missing
    unless more than ``MOST_HOT_KEYS`` were found.
    """

    hashes: list[int]
    estimates: list[int]
    rows: int
    error: int


def heavy_keys(df: DataFrame, key: Column, tracked: int = TRACKED_KEYS) -> HeavyKeys:
    """The frequent values of ``key``, a 64-bit hash, in one pass over the table.

    Every task keeps a frequent-items summary of ``tracked`` keys at most. Summaries are merged in groups of tasks
    first, so that what meets in the last task does not grow with their number.
    """
    sketch = F.call_function("approx_top_k_accumulate", F.col("_h"), F.lit(tracked)).alias("_s")
    parts = df.select(key.alias("_h"), F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_p"))
    merged = parts.groupBy("_p").agg(sketch, F.count(F.lit(1)).alias("_n"))
    # Grouped, all in one group: a task without rows cannot hand on a summary.
    whole = merged.groupBy(F.pmod("_p", F.lit(1))).agg(
        F.call_function("approx_top_k_combine", F.col("_s"), F.lit(tracked)).alias("_s"), F.sum("_n").alias("_n")
    )
    most = min(MOST_HOT_KEYS, tracked)
    found = whole.select(F.call_function("approx_top_k_estimate", F.col("_s"), F.lit(most)).alias("top"), "_n").first()
    if found is None or not found["_n"]:
        return HeavyKeys([], [], 0, 0)
    top = found["top"] or []
    error = int(found["_n"] * _ERROR / tracked)
    return HeavyKeys([t["item"] for t in top], [t["count"] for t in top], found["_n"], error)


def _common_types(left: DataFrame, right: DataFrame, keys: list[str]) -> list[str]:
    """The type in which Spark compares each key of the two tables."""
    both = left.select(*keys).limit(0).union(right.select(*keys).limit(0))
    return [field.dataType.simpleString() for field in both.schema]


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str,
    salt: int = DEFAULT_SALT,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """A shuffled join whose hot keys are spread over ``salt`` parts. ``salt`` below 2: a plain one.

    The keys of the large side are summarised now, without a shuffle of its rows; the query then names the hot ones
    itself, so each side is shuffled once. A key counts as hot by the hash of its values: another key of equal
    hash is spread, too, which changes no result.
    """
    plain = large.join(small.hint("merge"), keys, how)
    if salt < 2:
        return plain
    kinds = _common_types(large, small, keys)

    def hashed() -> Column:
        return F.xxhash64(*[F.col(f"`{k}`").cast(kind) for k, kind in zip(keys, kinds, strict=True)])

    heavy = heavy_keys(large, hashed())
    hashes = [h for h, n in zip(heavy.hashes, heavy.estimates, strict=True) if n > hot_rows]
    if not hashes:
        return plain
    hot = hashed().isin(hashes)
    own = row_salt(salt, large.columns)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0)))
    left = large.withColumn(SALT, F.when(hot, own).otherwise(0))
    right = small.withColumn(SALT, F.explode(copies))
    return left.join(right.hint("merge"), [*keys, SALT], how).drop(SALT)
