from clickflow.plans.sessions import session_top, session_top_sql
from clickflow.plans.traffic import daily_pv, daily_uv, distinct_day_guid, pv_join_uv, pv_union_uv
from clickflow.plans.weblog import (
    content_size_stats,
    content_size_stats_sql,
    ip_over_n,
    ip_over_n_sql,
    log_reports,
    response_code_count,
    response_code_count_sql,
    top_endpoints,
    top_endpoints_sql,
)

__all__ = [
    "content_size_stats",
    "content_size_stats_sql",
    "daily_pv",
    "daily_uv",
    "distinct_day_guid",
    "ip_over_n",
    "ip_over_n_sql",
    "log_reports",
    "pv_join_uv",
    "pv_union_uv",
    "response_code_count",
    "response_code_count_sql",
    "session_top",
    "session_top_sql",
    "top_endpoints",
    "top_endpoints_sql",
]
