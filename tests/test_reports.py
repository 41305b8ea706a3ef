"""Log, traffic and session reports: edge cases, and each report done two ways."""

from __future__ import annotations

from decimal import Decimal

import pytest

from clickflow import operators, plans, sources
from tests.conftest import rows
from workload import inputs


@pytest.fixture(scope="module")
def logs(spark, sf_dir):
    with operators.cached(sources.access_log(inputs.log_lines(spark, sf_dir))) as table:
        yield table


@pytest.fixture(scope="module")
def track(spark, sf_dir):
    with operators.cached(sources.track_log(inputs.track_lines(spark, sf_dir))) as table:
        yield table


def sizes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "contentSize long")


def test_size_stats_divide_integers(spark):
    assert rows(plans.content_size_stats(sizes(spark, 1, 2, 2))) == [(1, 1, 2, 5, 3)]


def test_size_stats_of_an_empty_log(spark):
    assert rows(plans.content_size_stats(sizes(spark))) == [(None, None, None, None, 0)]
    operators.register(sizes(spark), "empty_log")
    assert rows(plans.content_size_stats_sql(spark, "empty_log")) == [(None, None, None, None, 0)]


def test_size_stats_beyond_64_bits(spark):
    top = 2**63 - 1
    assert rows(plans.content_size_stats(sizes(spark, top, top))) == [(top, top, top, Decimal(2 * top), 2)]


def test_reports_by_sql_and_by_dataframe(spark, logs):
    with operators.cached_view(logs, "pair_log") as view:
        assert spark.catalog.isCached(view)
        reports = plans.log_reports(logs, n=50)
        assert rows(plans.content_size_stats_sql(spark, view)) == rows(reports["content_size_stats"])
        assert rows(plans.response_code_count_sql(spark, view)) == rows(reports["response_code_count"])
        assert rows(plans.ip_over_n_sql(spark, view, n=50)) == rows(reports["ip_over_n"])
        assert rows(plans.top_endpoints_sql(spark, view)) == rows(reports["top_endpoints"])
    assert not spark.catalog.isCached("pair_log")


def test_ip_over_n_is_strict_ordered_and_limited(spark):
    hits = [("c",)] * 3 + [("b",)] * 3 + [("a",)] * 2 + [("d",)] * 4
    df = spark.createDataFrame(hits, "ipAddress string")
    assert [tuple(r) for r in plans.ip_over_n(df, n=2, limit=2).collect()] == [("b", 3), ("c", 3)]


def test_join_and_union_equal_their_plain_forms(track):
    pv, uv = plans.daily_pv(track), plans.daily_uv(track)
    assert rows(plans.pv_join_uv(track)) == rows(pv.join(uv, "day"))
    plain = pv.withColumnRenamed("pv", "n").union(uv.withColumnRenamed("uv", "n"))
    assert rows(plans.pv_union_uv(track)) == rows(plain)
    tagged = plans.pv_union_uv(track, with_metric=True)
    assert rows(tagged.where("metric = 'uv'").select("day", "n")) == rows(uv)


def test_traffic_edges(spark):
    df = spark.createDataFrame(
        [
            ("d1", "u", "g"),
            ("d1", "\t", "g"),
            ("d1", "", ""),
            ("d1", "u", ""),
            ("d2", " ", "g"),
        ],
        "day string, url string, guid string",
    )
    assert rows(plans.daily_pv(df)) == [("d1", 2)]
    assert rows(plans.daily_uv(df)) == [("d1", 2), ("d2", 1)]
    assert rows(plans.distinct_day_guid(df)) == [("d1", ""), ("d1", "g"), ("d2", "g")]
    assert rows(plans.pv_join_uv(df)) == [("d1", 2, 2)]
    assert rows(plans.pv_union_uv(df)) == [("d1", 2), ("d1", 2), ("d2", 1)]


def test_traffic_reads_the_log_once(spark, sf_dir):
    log = sources.track_log(inputs.page_view_lines(spark, sf_dir), on_short="drop")
    for plan in (plans.pv_join_uv(log), plans.pv_union_uv(log)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1
        assert "Join" not in text


def test_sessions_by_sql_and_by_dataframe(spark, sf_dir):
    views = sources.page_views(inputs.page_view_lines(spark, sf_dir))
    operators.register(views, "pair_views")
    by_sql = plans.session_top_sql(spark, "pair_views", k=7)
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in plans.session_top(views, 7).collect()]
    assert by_sql.count() == 7


def test_view_names_are_not_sql_text(spark):
    with pytest.raises(Exception):
        plans.session_top_sql(spark, "x; drop table y").collect()


def test_addresses_over_n_are_all_there_unless_limited(spark):
    logs = spark.createDataFrame([(f"10.0.0.{i % 40}",) for i in range(120)], "ipAddress string")
    operators.register(logs, "many_ips")
    assert plans.ip_over_n(logs, n=2).count() == plans.ip_over_n_sql(spark, "many_ips", n=2).count() == 40
    few = plans.ip_over_n(logs, n=2, limit=3)
    assert rows(few) == rows(plans.ip_over_n_sql(spark, "many_ips", n=2, limit=3))
    assert [r[0] for r in rows(few)] == ["10.0.0.0", "10.0.0.1", "10.0.0.10"]
