"""Positional rows: one separator, fields picked by position."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.operators.checks import keep_or_raise

OnShort = Literal["fail", "drop"]


def fields_of(line: Column, sep: str) -> Column:
    """The line cut at every ``sep``; empty fields are kept, also at the end."""
    return F.split(line, sep if re.escape(sep) == sep or sep in " \t" else rf"\Q{sep}\E")


def positional_table(
    lines: DataFrame,
    sep: str,
    fields: Sequence[tuple[str, int]],
    on_short: OnShort = "fail",
    column: str = "value",
) -> DataFrame:
    """String columns ``(name, zero-based index)`` of each line; further fields are ignored.

    A line with too few fields stops the job, or is left out with ``on_short="drop"``.
    """
    if on_short not in ("fail", "drop"):
        raise ValueError(f"on_short must be 'fail' or 'drop', not {on_short!r}")
    needed = 1 + max(index for _, index in fields)
    # The one-element explode cuts the line once, for the check and for all columns.
    cut = lines.where(F.col(column).isNotNull()).select(
        F.explode(F.array(fields_of(F.col(column), sep))).alias("parts")
    )
    enough = F.size("parts") >= needed
    if on_short == "fail":
        message = F.lit(f"line with fewer than {needed} fields: ")
        enough = keep_or_raise(enough, F.concat(message, F.array_join("parts", sep)))
    return cut.where(enough).select(
        *[F.get("parts", F.lit(index)).alias(name) for name, index in fields]
    )


def group_pairs(lines: DataFrame, on_short: OnShort = "fail", column: str = "value") -> DataFrame:
    """``key value`` lines, separated by one space, as (key string, value int).

    ``on_short`` also decides about a value that is no int.
    """
    pairs = positional_table(lines, " ", [("key", 0), ("raw", 1)], on_short, column)
    value = F.col("raw").try_cast("int")
    is_int = value.isNotNull()
    if on_short == "fail":
        is_int = keep_or_raise(is_int, F.concat(F.lit("no int: "), F.col("raw")))
    return pairs.where(is_int).select("key", value.alias("value"))
