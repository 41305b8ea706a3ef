"""``sel_max``: the highest value, never below 0.0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _no_nan(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(value), value)


def sel_max(column: str | Column) -> Column:
    """Native aggregate that starts from 0.0: negative, NaN, null or no input gives 0.0."""
    return F.greatest(F.coalesce(F.max(_no_nan(column)), F.lit(0.0)), F.lit(0.0))


def sel_max_sql(expression: str) -> str:
    """The same as a fragment of SQL text, for any numeric expression, beside any other aggregate."""
    value = f"cast(({expression}) as double)"
    return f"greatest(coalesce(max(if(isnan({value}), null, {value})), 0.0D), 0.0D)"
