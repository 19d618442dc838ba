"""Behaviour at the edges, on literal rows."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from footfall.functions.url import uri_host
from footfall import report
from tests.logs import day, event, log_of


@pytest.fixture
def rows_of(spark):
    """Rows of a report over literal events, narrowed to the given dimension values."""

    def run(name, *events, first=None, last=None, **values):
        found = report(name, log_of(spark, *events), first, last).collect()
        return [row for row in found if all(row[column] == value for column, value in values.items())]

    return run


TOTAL = {"lib": "all", "project_name": "all"}


def one(rows):
    assert len(rows) == 1, rows
    return rows[0]


def test_raw_empty_value_stays_apart_from_the_total(rows_of):
    events = (event(1, lib="", event="x", distinct_id="u2"), event(1))
    rows = rows_of("flow_summary_bydate", *events, project_name="all")
    assert sorted((row.lib, row.pv, row.visit_count) for row in rows) == [("", 0, 1), ("all", 1, 2), ("js", 1, 1)]


def test_visit_counts_again_only_after_more_than_seven_days(rows_of):
    events = (
        event(1, event_session_id="eight"),
        event(9, event_session_id="eight"),
        event(2, event_session_id="seven"),
        event(9, event_session_id="seven"),
    )
    whole = {row.stat_date: row.visit_count for row in rows_of("flow_summary_bydate", *events, **TOTAL)}
    assert whole == {day(1): 1, day(2): 1, day(9): 1}
    alone = one(rows_of("flow_summary_bydate", *events, first=day(9), last=day(9), **TOTAL))
    assert alone.visit_count == 1


def test_bounce_is_a_single_event_not_a_short_visit(rows_of):
    events = (
        event(1, "10:00:00", event_session_id="single", event="$WebClick"),
        event(1, "10:00:00", event_session_id="double"),
        event(1, "10:00:00", event_session_id="double"),
    )
    row = one(rows_of("flow_summary_bydate", *events, **TOTAL))
    assert (row.visit_count, row.bounce, row.visit_time, row.pv) == (2, 1, 0, 2)


def page_rows(rows):
    return {row.url: row for row in rows if row.url != "all"}


STANDARD_TOTAL = {**TOTAL, "is_first_day": "all", "country": "all", "province": "all"}


def test_all_pages_of_the_first_and_last_second_are_entries_and_exits(rows_of):
    events = (
        event(1, "10:00:00", url="https://a.b/1"),
        event(1, "10:00:00", url="https://a.b/2"),
        event(1, "10:00:05", url="https://a.b/3"),
        event(1, "10:00:05", url="https://a.b/4"),
    )
    pages = page_rows(rows_of("visituri_detail_bydate", *events, **STANDARD_TOTAL))
    flow = {url[-1]: (row.entry_count, row.exit_count, row.down_pv_count) for url, row in pages.items()}
    assert flow == {"1": (1, 0, 0), "2": (1, 0, 0), "3": (0, 1, 1), "4": (0, 1, 1)}


def test_page_flow_matches_by_session_alone(rows_of):
    events = (
        event(1, "10:00:00", project_name="alpha", url="https://a.b/1"),
        event(1, "10:00:10", project_name="beta", url="https://a.b/2"),
        event(1, "10:00:20", project_name="alpha", url="https://a.b/2"),
    )
    rows = rows_of("visituri_detail_bydate", *events, **{**STANDARD_TOTAL, "project_name": "beta"})
    pages = page_rows(rows)
    # beta's span is one second; the page before it belongs to no group of beta.
    assert pages.keys() == {"https://a.b/2"}
    assert (pages["https://a.b/2"].entry_count, pages["https://a.b/2"].exit_count) == (1, 1)
    alpha = page_rows(rows_of("visituri_detail_bydate", *events, **{**STANDARD_TOTAL, "project_name": "alpha"}))
    assert alpha["https://a.b/2"].down_pv_count == 2


def test_groups_without_sessions_have_zeros(rows_of):
    row = one(rows_of("flow_summary_bydate", event(1, event_session_id=""), **TOTAL))
    assert (row.pv, row.uv, row.visit_count, row.visit_time, row.bounce) == (1, 1, 0, 0, 0)


def test_histogram_classes_a_visitor_per_dimension_tuple(rows_of):
    events = (event(1, province="Beijing"), event(1, province="Zhejiang"))
    row = one(rows_of("user_pv_bydate", *events, **STANDARD_TOTAL))
    assert (row.pv1_uv, row.pv2_5_uv) == (1, 0)


def test_lifecycle_stages(rows_of):
    active = {"three_ago": (1,), "yesterday": (3,), "both": (3, 4), "today_and_two_ago": (2, 4), "four_ago": (0,)}
    events = [event(number, distinct_id=who) for who, days in active.items() for number in days]
    events.append(event(4, distinct_id="fresh", is_first_day="true"))
    total = {**TOTAL, "country": "all", "province": "all", "stat_date": day(4)}
    row = one(rows_of("visitor_life_bydate", *events, **total))
    assert row.new_users == 1
    assert row.continuous_active_users == 1
    assert row.revisit_users == 2
    assert row.silent_users == 1
    assert row.churn_users == 1


def test_session_counts_in_each_hour_but_on_one_day(rows_of):
    events = (event(1, "22:50:00"), event(1, "23:30:00"), event(2, "00:10:00"))
    by_hour = rows_of("flow_trend_byhour", *events, **STANDARD_TOTAL)
    assert {(row.stat_date, row.stat_hour): row.visit_count for row in by_hour} == {
        (day(1), "22"): 1,
        (day(1), "23"): 1,
        (day(2), "00"): 1,
    }
    by_day = rows_of("flow_trend_bydate", *events, **STANDARD_TOTAL)
    assert {row.stat_date: row.visit_count for row in by_day} == {day(1): 1, day(2): 0}


def test_hour_of_day_looks_back_where_the_hourly_summary_does_not(rows_of):
    events = (event(1, "10:00:00"), event(2, "10:30:00"))
    trend = rows_of("flow_trend_byhour", *events, **STANDARD_TOTAL)
    assert {row.stat_date: row.visit_count for row in trend} == {day(1): 1, day(2): 0}
    summary = rows_of("flow_summary_byhour", *events, **TOTAL)
    assert {row.stat_date: row.visit_count for row in summary} == {day(1): 1, day(2): 1}


def test_time_classes_include_their_lower_bound(rows_of):
    events = [
        event(1, clock, distinct_id=f"u{seconds}", event_session_id=f"s{seconds}")
        for seconds, end in ((9, "10:00:09"), (10, "10:00:10"), (30, "10:00:30"), (3600, "11:00:00"))
        for clock in ("10:00:00", end)
    ]
    row = one(rows_of("user_visittime_bydate", *events, **STANDARD_TOTAL))
    assert (row.vt0_10_uv, row.vt10_30_uv, row.vt30_60_uv, row.vt1800_3600_uv, row.vt3600_uv) == (1, 1, 1, 0, 1)


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("https://a.b/c", "https://a.b"),
        ("http://user@a.b:8080/c?x=1 2", "http://a.b"),
        ("pages/index", ""),
        ("", ""),
        ("https://a.b?u=https://x.y/", "https://a.b"),
    ],
)
def test_page_host(rows_of, url, host):
    rows = [row for row in rows_of("visituri_detail_bydate", event(1, url=url), **STANDARD_TOTAL) if row.url != "all"]
    assert one(rows).uri_host == host


def test_empty_day_has_only_lifecycle_rows(rows_of):
    events = (event(1), event(4))
    assert {row.stat_date for row in rows_of("flow_summary_bydate", *events)} == {day(1), day(4)}
    total = {**TOTAL, "country": "all", "province": "all"}
    stages = {row.stat_date: row for row in rows_of("visitor_life_bydate", *events, **total)}
    assert stages.keys() == {day(1), day(2), day(3), day(4)}
    assert (stages[day(2)].silent_users, stages[day(3)].churn_users) == (1, 1)


def test_lifecycle_ends_three_days_after_the_last_activity(rows_of):
    total = {**TOTAL, "country": "all", "province": "all"}
    rows = rows_of("visitor_life_bydate", event(1), first=day(1), last=day(9), **total)
    assert sorted(row.stat_date for row in rows) == [day(1), day(2), day(3), day(4)]


def test_empty_search_word_is_a_group_of_the_summary_but_not_of_the_detail(rows_of):
    events = (event(1, latest_search_keyword=""), event(1), event(1, latest_search_keyword="未取到值"))
    summary = rows_of("searchword_summary_bydate", *events, **TOTAL)
    assert {row.latest_search_keyword: row.pv for row in summary} == {"": 1, "word": 1, "all": 2}
    detail = rows_of("searchword_detail_bydate", *events, **STANDARD_TOTAL)
    assert {row.latest_search_keyword: row.pv for row in detail} == {"word": 1, "all": 1}


def test_failed_and_missing_referrers_are_direct_access(rows_of):
    events = [event(1, latest_referrer_host=host) for host in ("", "url的domain解析失败", "取值异常", "r.example")]
    rows = rows_of("sourcesite_detail_bydate", *events, **STANDARD_TOTAL)
    assert {row.latest_referrer_host: row.pv for row in rows} == {"直接访问": 2, "r.example": 1, "all": 3}


def test_visits_repeat_over_first_day_values_in_visitor_info(rows_of):
    events = (event(1, "10:00:00", is_first_day="true"), event(1, "10:00:30", is_first_day="false"))
    rows = rows_of("visitor_detail_byinfo", *events)
    assert [(row.visit_count, row.visit_time, row.pv) for row in rows] == [(1, 30, 1), (1, 30, 1)]


def test_page_views_repeat_over_referrers_of_a_session(rows_of):
    events = (event(1, latest_referrer_host="a.example"), event(1, latest_referrer_host="b.example"))
    rows = rows_of("visitor_detail_bysession", *events)
    assert sorted((row.sourcesite, row.pv) for row in rows) == [("a.example", 2), ("b.example", 2)]


def test_visitor_reports_leave_out_empty_visitors(rows_of):
    for name in ("visitor_summary_byvisitor", "visitor_detail_byinfo"):
        assert rows_of(name, event(1, distinct_id="")) == []


def test_missing_texts_read_as_empty(rows_of):
    assert one(rows_of("area_detail_bydate", event(1, city=None), **STANDARD_TOTAL, city="未知城市")).pv == 1


def test_visit_time_does_not_depend_on_the_session_zone(spark, rows_of):
    events = (event(70, "01:30:00"), event(70, "03:30:07"))  # the night in which New York skips an hour
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(rows_of("flow_summary_bydate", *events, **TOTAL)).visit_time == 7207
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_host_with_and_without_scheme(spark):
    addresses = {
        "http://a.b/c": "http://a.b",
        "https://u:p@h.de:80/q?x": "https://h.de",
        "httpbin.org/x": "://httpbin.org",
        "http://localhost/x.y": "http://",
        "ftp://a.b": "",
        "": "",
    }
    rows = spark.createDataFrame([(url,) for url in addresses], "url string").selectExpr("url", f"{uri_host('url')} AS host")
    assert dict(rows.collect()) == addresses


def test_rows_without_an_hour_are_no_rows_of_hourly_reports(spark):
    log = log_of(spark, event(1)).withColumn("stat_hour", F.lit(""))
    assert report("flow_summary_byhour", log).count() == 0
    assert report("flow_trend_byhour", log).count() == 0
