from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A JVM ``trim`` cuts characters up to the space. Spark's ``trim`` cuts spaces only.
_LAST_TRIMMED = 0x20
_VISIBLE = r"[^\x00-\x20]"


def is_non_blank(column: str | Column) -> Column:
    """True if the text still has a character after trimming everything up to the space."""
    text = F.col(column) if isinstance(column, str) else column
    # The first character settles it for nearly every row, without a regular expression.
    return (F.ascii(text) > _LAST_TRIMMED) | text.rlike(_VISIBLE)


def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_non_blank(column))
