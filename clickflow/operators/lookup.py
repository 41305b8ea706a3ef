"""Dimension joins: shuffled, and map-side with a strict miss policy."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.operators.checks import keep_or_raise
from clickflow.operators.salting import DEFAULT_HOT_ROWS, DEFAULT_SALT, salted_join
from clickflow.operators.sizes import DEFAULT_BROADCAST_BYTES, if_small

_HIT = "_hit"


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    strategy: Literal["broadcast", "merge"] = "broadcast",
    salt: int = DEFAULT_SALT,
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Inner equi-join: duplicates multiply, misses drop.

    ``broadcast`` leaves the fact rows where they are if the measured dimension is within ``max_bytes``,
    and shuffles otherwise. ``merge`` always shuffles both sides, with keys of more than ``hot_rows`` rows salted.
    """
    keys = _as_list(key)
    small = if_small(dim, max_bytes) if strategy == "broadcast" else None
    if small is not None:
        return fact.join(F.broadcast(small), keys, "inner")
    return salted_join(fact, dim, keys, "inner", salt, hot_rows)


def _about_key(text: str, keys: list[str]) -> Column:
    return F.concat(F.lit(text), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))


def _one_row_per_key(dim: DataFrame, keys: list[str], order_by: str | None) -> DataFrame:
    """The dimension with unique keys. Both forms combine before the shuffle."""
    rest = [c for c in dim.columns if c not in keys and c != order_by]
    known = dim.where(" and ".join(f"`{k}` is not null" for k in keys))
    if order_by is not None:
        last = known.groupBy(*keys).agg(F.max(F.struct(order_by, *rest)).alias("last"))
        return last.select(*keys, *[F.col(f"last.`{c}`") for c in rest])
    counted = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.any_value(c).alias(c) for c in rest]
    )
    message = _about_key("more than one dimension row for ", keys)
    return counted.where(keep_or_raise(F.col("n") == 1, message)).drop("n")


def dim_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    on_miss: Literal["fail", "drop", "null"] = "fail",
    order_by: str | None = None,
    salt: int = DEFAULT_SALT,
    hot_rows: int = DEFAULT_HOT_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Each fact row with the one dimension row of its key.

    Duplicate dimension keys stop the job unless ``order_by`` names the column whose highest value
    wins. A fact row without a match stops the job, is dropped, or gets nulls. The dimension is
    broadcast while its measured size is within ``max_bytes``; beyond that the join is shuffled
    with hot keys salted.
    """
    if on_miss not in ("fail", "drop", "null"):
        raise ValueError(f"on_miss must be 'fail', 'drop' or 'null', not {on_miss!r}")
    keys = _as_list(key)
    unique = _one_row_per_key(dim, keys, order_by)
    how = "inner" if on_miss == "drop" else "left"
    if on_miss == "fail":
        unique = unique.withColumn(_HIT, F.lit(True))
    small = if_small(unique, max_bytes)
    if small is not None:
        joined = fact.join(F.broadcast(small), keys, how)
    else:
        joined = salted_join(fact, unique, keys, how, salt, hot_rows)
    if on_miss != "fail":
        return joined
    message = _about_key("no dimension row for ", keys)
    return joined.where(keep_or_raise(F.col(_HIT).isNotNull(), message)).drop(_HIT)
