from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keep_or_raise(condition: Column, message: Column) -> Column:
    """A filter that keeps rows meeting the condition and stops the job at one that does not.

    As a filter it cannot be pruned away with unused columns.
    """
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
