"""The answers computed from the typed tables by SQL that DuckDB runs."""

from __future__ import annotations

from workload.inputs import NEW_DELIVERIES
from workload.queries import DAY, MANY_REQUESTS


def _lines(table: str, where: str = "true", extra: str = "") -> str:
    return rf"""select unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) as line{extra}
        from {table} where {where}"""


def _words(lines: str, extra: str = "") -> str:
    return f"""select unnest(case
            when line = '' then ['']
            when rtrim(line, ' ') = '' then []::varchar[]
            else string_split(rtrim(line, ' '), ' ') end) as word{extra}
        from ({lines})"""


_DOCUMENT_LINES = _lines("documents")
_DOCUMENT_WORDS = _words(_DOCUMENT_LINES)
_WORD_COUNT = f"select word, count(*) as cnt from ({_DOCUMENT_WORDS}) group by word"
_SPACED_LINES = rf"""select regexp_replace(line, '([,.?])', ' \1', 'g') as line
    from ({_DOCUMENT_LINES})"""
_WITHOUT_STOP_TABLE = f"""select word, cnt from ({_WORD_COUNT})
    where word not in (select word from ({_words(_lines("benchmark"))}))"""

# 0 for the first delivery of the streams, 1 for the second.
_DELIVERY = "case when lang is not distinct from 'en' then 0 else 1 end::bigint as batch_id"
_DELIVERED_LINES = _lines("documents", extra=f", {_DELIVERY}")

_BATCH_WORD_COUNT = f"""select batch_id, word, count(*) as cnt
    from ({_words(_DELIVERED_LINES, ", batch_id")}) group by batch_id, word"""

_IP = "'10.' || (user_id // 65536) || '.' || (user_id // 256 % 256) || '.' || (user_id % 256)"
_ENDPOINT = r"'/' || event_type || '/' || regexp_extract(props, '(\d+)', 1)"
_CODE = "case event_type when 'error' then 500 else 200 end"
_SIZE = "event_id * 37 % 10007"
_LOGS = f"""select {_IP} as ip, {_ENDPOINT} as endpoint, {_CODE} as code, {_SIZE} as size
    from events where event_type <> 'signup'"""
_LOG_TIME = "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'"

_SIZE_STATS = f"""select (sum(size) // count(*))::bigint as avg_size, min(size) as min_size,
    max(size) as max_size, sum(size)::decimal(38, 0) as total_size, count(*) as cnt from ({_LOGS})"""
_CODE_COUNT = f'select code as "responseCode", count(*) as cnt from ({_LOGS}) group by code'
_IP_OVER_N = f"""select ip as "ipAddress", count(*) as cnt from ({_LOGS}) group by ip
    having count(*) > {MANY_REQUESTS}"""
_TOP_ENDPOINTS = f"""select endpoint, count(*) as cnt from ({_LOGS})
    group by endpoint order by cnt desc, endpoint limit 5"""

_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_VIEW_LINE = f"""concat_ws(chr(9), {_TIME}, '/' || event_type, 's' || user_id, '-',
    '10.0.0.' || (user_id % 256), user_id, user_id % 25)"""
_SESSIONS = """select 's' || user_id as session_id, count(*) as cnt from events
    group by user_id order by cnt desc, session_id limit 10"""

_TRACK = """select strftime(ts, '%Y-%m-%d') as day,
    case event_type when 'error' then ' ' else 'http://shop.example/' || event_type end as url,
    case event_type when 'view' then '' else user_id::varchar end as guid from events"""
_PV = f"select day, count(*) as pv from ({_TRACK}) where url <> ' ' group by day"
_UV = f"select day, count(distinct guid) as uv from ({_TRACK}) group by day"

_EMP_DEPT = """select c_nationkey::varchar as deptno, c_name as ename, n_name as dname
    from customer join nation on c_nationkey = n_nationkey"""

_GROUP_TOP = """select l_returnflag as key, l_partkey::int as value,
    (row_number() over (partition by l_returnflag order by l_partkey desc))::int as rank
    from lineitem qualify rank <= 3"""

_SEL_MAX = """select c_mktsegment, greatest(coalesce(max(c_acctbal), 0.0), 0.0)::double as highest,
    greatest(coalesce(max(c_acctbal - 20000), 0.0), 0.0)::double as all_negative
    from customer group by c_mktsegment"""
_SEL_MAX_SQL = f"""select s.*, falling, cnt from ({_SEL_MAX}) s join (select c_mktsegment,
    greatest(coalesce(max(-c_acctbal), 0.0), 0.0)::double as falling, count(*) as cnt
    from customer group by c_mktsegment) using (c_mktsegment)"""

_WINDOW_WORDS = f"""with b as (
            select unnest([(day - 1) * 86400, day * 86400]) as window_start, word from
            ({_words("select text as line, doc_id * 60 // 86400 as day from documents", ", day")}))
        select window_start, window_start + 172800 as window_end, word, count(*) as cnt
        from b group by window_start, word"""

# 0 to 3 for the four languages' deliveries, 4 for the rest.
_LANGUAGE_DELIVERY = """coalesce(list_position(['en', 'de', 'es', 'fr'], lang) - 1, 4)::bigint as batch_id"""


def _visits() -> str:
    """Deliveries in turn: what a user's state becomes, who is gone by the latest time seen, who is kept."""
    first, second = NEW_DELIVERIES
    steps = [
        f"""found as (select user_id, (ts >= date '{first}')::int + (ts >= date '{second}')::int as batch,
            epoch_ms(ts) as ms from events)""",
        "kept as (select null::bigint as user_id, null::bigint as n, null::bigint as last where false)",
    ]
    rows, kept = [], "kept"
    for i in range(3):
        steps.append(f"""now{i} as (select user_id, coalesce(k.n, 0) + coalesce(d.n, 0) as n,
            coalesce(d.last, k.last) as last, d.n is not null as touched,
            coalesce(d.last, k.last) + 43200000 <= (select max(ms) from found where batch <= {i}) as gone
            from {kept} k full join
                (select user_id, count(*) as n, max(ms) as last from found where batch = {i} group by user_id) d
            using (user_id))""")
        rows.append(f"select user_id, n as cnt, false as expired from now{i} where touched")
        rows.append(f"select user_id, n, true from now{i} where gone")
        kept = f"(select user_id, n, last from now{i} where not gone)"
    return f"with {', '.join(steps)} {' union all '.join(rows)}"


_VISITS = _visits()

ORACLE_SQL: dict[str, str] = {
    "scan_text": f"select line as value from ({_DOCUMENT_LINES})",
    "scan_partition_dir": f"""select {_VIEW_LINE} as value, '{DAY}' as day from events
        where strftime(ts, '%Y-%m-%d') = '{DAY}'""",
    "scan_csv": """select l_orderkey as user_id, l_partkey as item_id, l_quantity as rating,
        l_linenumber::bigint as position from lineitem""",
    "scan_json": "select * from customer",
    "scan_parquet": "select * from supplier",
    "row_count": "select count(*) as cnt from lineitem",
    "scan_page_views": f"""select {_TIME} as track_time, '/' || event_type as url,
        's' || user_id as session_id, '-' as referer, '10.0.0.' || (user_id % 256) as ip,
        user_id::varchar as end_user_id, (user_id % 25)::varchar as city_id from events""",
    "scan_track_log": _TRACK,
    "scan_access_log": f"""select {_IP} as "ipAddress", '-' as "clientIdented",
        'u' || user_id as "userId", {_LOG_TIME} as "dateTime", 'GET' as method,
        {_ENDPOINT} as endpoint, 'HTTP/1.1' as protocol, {_CODE} as "responseCode",
        {_SIZE} as "contentSize" from events where event_type <> 'signup'""",
    "log_valid_lines": f"""select {_IP} || ' - u' || user_id || ' [' || {_LOG_TIME}
        || '] "GET ' || {_ENDPOINT} || ' HTTP/1.1" ' || {_CODE} || ' ' || ({_SIZE})
        || case event_type when 'click' then ' "http://shop.example/" "agent 1.0"' else '' end
        as value from events where event_type <> 'signup'""",
    "log_line_counts": f"""select (select count(*) from events) as read, count(*) as valid,
        (select count(*) from events where event_type = 'signup') as rejected,
        sum(size)::decimal(38, 0) as total_size from ({_LOGS})""",
    "log_rejected_lines": f"""select {_IP} || ' - u' || user_id || ' [' || {_LOG_TIME}
        || '] "GET ' || {_ENDPOINT} || ' HTTP/1.1" ' || {_CODE} || ' -' as value
        from events where event_type = 'signup'""",
    "words": _DOCUMENT_WORDS,
    "word_count": _WORD_COUNT,
    "word_count_stop_list": f"""select word, count(*) as cnt from ({_words(_SPACED_LINES)})
        where word not in (',', '.', '#', '$', '!', '?', '@') group by word""",
    "word_count_stop_table": _WITHOUT_STOP_TABLE,
    "word_count_stop_shuffled": _WITHOUT_STOP_TABLE,
    "top_words": f"select word, cnt from ({_WORD_COUNT}) order by cnt desc, word limit 3",
    "kafka_word_count": _WORD_COUNT,
    "content_size_stats": _SIZE_STATS,
    "content_size_stats_sql": _SIZE_STATS,
    "response_code_count": _CODE_COUNT,
    "response_code_count_sql": _CODE_COUNT,
    "ip_over_n": _IP_OVER_N,
    "ip_over_n_sql": _IP_OVER_N,
    "top_endpoints": _TOP_ENDPOINTS,
    "top_endpoints_sql": _TOP_ENDPOINTS,
    "daily_pv": _PV,
    "daily_uv": _UV,
    "distinct_day_guid": f"select distinct day, guid from ({_TRACK})",
    "pv_join_uv": f"select day, pv, uv from ({_PV}) join ({_UV}) using (day)",
    "pv_union_uv": f"select day, pv as n from ({_PV}) union all select day, uv as n from ({_UV})",
    "session_top10": _SESSIONS,
    "session_top10_sql": _SESSIONS,
    "select_upper": """select 's' || user_id as session_id, upper('s' || user_id) as uuid
        from events""",
    "select_lower": "select c_custkey, lower(c_mktsegment) as segment from customer",
    "emp_dept_join": _EMP_DEPT,
    "emp_dept_join_shuffled": _EMP_DEPT,
    "emp_dept_lookup": _EMP_DEPT,
    "heavy_keys": "select l_returnflag, count(*) as cnt from lineitem group by l_returnflag",
    "group_top3": _GROUP_TOP,
    "group_top3_salted": _GROUP_TOP,
    "group_top3_selected": _GROUP_TOP,
    "group_top3_list": f"""select key, string_agg(value, ',' order by value desc) as top_values
        from ({_GROUP_TOP}) group by key""",
    "sel_max": _SEL_MAX,
    "sel_max_sql": _SEL_MAX_SQL,
    "sel_max_named": _SEL_MAX_SQL,
    "sink_text_tsv": f"select word || chr(9) || cnt as value from ({_WORD_COUNT})",
    "sink_jdbc": "select event_type, count(*) as cnt from events group by event_type",
    "sink_jdbc_once": "select event_type, count(*) as cnt from events group by event_type",
    "stream_batch_word_count": _BATCH_WORD_COUNT,
    "sink_batch_log": _BATCH_WORD_COUNT,
    "sink_batch_files": f"""select batch_id, line as value, 19::int as time_length
        from ({_DELIVERED_LINES})""",
    "sink_batch_text": f"""select batch_id, word || chr(9) || count(*) as value
        from ({_words(_DELIVERED_LINES, ", batch_id")}) group by batch_id, word""",
    "stream_running_count": f"""select b.batch_id, word, count(*) as cnt
        from ({_words(_DELIVERED_LINES, ", batch_id")}) w, (values (0::bigint), (1::bigint)) b(batch_id)
        where w.batch_id <= b.batch_id group by b.batch_id, word""",
    "stream_restart_count": f"""with w as ({_words(_DELIVERED_LINES, ", batch_id")})
        select batch_id, word, (count(*) + case batch_id when 1 then
            (select count(*) from w e where e.word = w.word and e.batch_id = 0) else 0 end)::bigint as cnt
        from w group by batch_id, word""",
    "stream_window_count": """with b as (
            select time_bucket(interval 6 hours, ts, timestamp '1970-01-01')
                - interval 6 hours * k as s, event_type
            from events, (values (0), (1)) t(k))
        select epoch(s)::bigint as window_start, epoch(s + interval 12 hours)::bigint as window_end,
            event_type, count(*) as cnt
        from b
        group by s, event_type""",
    "stream_window_words": _WINDOW_WORDS,
    "stream_window_panes": _WINDOW_WORDS,
    "stream_window_arrival": f"""with w as (select word, batch_id, count(*) as n
            from ({_words(_lines("documents", extra=f", {_LANGUAGE_DELIVERY}"), ", batch_id")}) group by word, batch_id)
        select first_batch, last_batch, word, sum(n)::bigint as cnt
        from w, (values (0::bigint, 1::bigint), (1::bigint, 3::bigint)) b(first_batch, last_batch)
        where batch_id between first_batch and last_batch group by first_batch, last_batch, word""",
    "stream_state_count": _VISITS,
    "stream_redealt_count": _WORD_COUNT,
}
