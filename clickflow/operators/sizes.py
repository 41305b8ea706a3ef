"""Is a table small enough to be sent to every executor?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

DEFAULT_BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 32
_FIXED_WIDTH = 16


def broadcast_bytes(df: DataFrame) -> int:
    """Measured size of the table as join rows: one distributed aggregate, one number back.

    The aggregate computes the table once more; cache a table that is costly to compute.
    """
    fixed = _ROW_OVERHEAD + _FIXED_WIDTH * len(df.columns)
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        for f in df.schema.fields
        if not isinstance(f.dataType, NumericType)
    ]
    per_row = sum(widths, F.lit(fixed)).cast("bigint")
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame | None:
    """The table, if its measured size is within ``max_bytes``, else None.

    Measuring computes the table once more and keeps nothing; cache or write a table that is costly to compute.
    """
    return df if broadcast_bytes(df) <= max_bytes else None
