from clickflow.functions.aggregates import SEL_MAX, UserAggregate, register_aggregate
from clickflow.functions.sel_max import sel_max, sel_max_sql
from clickflow.functions.sql_names import register_functions

__all__ = ["SEL_MAX", "UserAggregate", "register_aggregate", "register_functions", "sel_max", "sel_max_sql"]
