"""Functions callable by name from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The SQL names and the built-ins they stand for.
_CASE_FUNCTIONS = {"toUpper": "upper", "toLower": "lower"}


def register_functions(spark: SparkSession) -> None:
    """Register ``toUpper`` and ``toLower`` in this session.

    They are SQL functions that the optimizer replaces by the built-in. SQL functions may not aggregate; a name
    for an aggregate, such as ``sel_max``, is given by ``register_aggregate``.
    """
    for name, builtin in _CASE_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(word STRING) "
            f"RETURNS STRING RETURN {builtin}(word)"
        )
