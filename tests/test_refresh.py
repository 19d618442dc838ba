"""Refresh modes over stored reports."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from footfall import REPORTS, refresh_day, refresh_days, refresh_full, report
from footfall.plans import STD, WITH_NEW
from tests.comparing import difference, spark_rows
from tests.logs import day, event, log_of, random_events

NAMES = ("flow_summary_bydate", "visitor_life_bydate", "user_visit_bydate", "visitor_detail_bysession")
EVENTS = random_events(seed=11, rows=150, days=12)


@pytest.fixture
def database(spark, request):
    name = "stat_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def stored(spark, database, name):
    return spark.table(f"{database}.{name}").drop("update_time")


def test_full_refresh_equals_day_by_day(spark, database):
    log = log_of(spark, *EVENTS).cache()
    refresh_full(log, database, NAMES, today=day(12))
    whole = {name: spark_rows(stored(spark, database, name)) for name in NAMES}
    for number in (1, 2, 8, 12):
        refresh_day(log, day(number), f"{database}", ("flow_summary_bydate", "visitor_life_bydate"))
    for name in NAMES:
        assert whole[name]
        assert difference(whole[name], spark_rows(report(name, log, None, day(12)))) == ""
        assert difference(spark_rows(stored(spark, database, name)), whole[name]) == ""


@pytest.mark.parametrize("name", ["flow_trend_bydate", "user_visittime_bydate", "visituri_detail_bydate"])
def test_range_and_single_day_equal_the_whole(spark, name):
    log = log_of(spark, *EVENTS).cache()
    whole = report(name, log).cache()
    for first, last in ((5, 9), (9, 9)):
        some = report(name, log, day(first), day(last))
        wanted = whole.filter(f"stat_date BETWEEN '{day(first)}' AND '{day(last)}'")
        assert difference(spark_rows(some), spark_rows(wanted)) == ""


def test_refreshing_twice_changes_nothing_and_drops_vanished_groups(spark, database):
    name = "flow_summary_bydate"
    refresh_days(log_of(spark, event(1), event(2, project_name="gone"), event(3)), day(1), day(3), database, [name])
    changed = log_of(spark, event(1, project_name="unseen"), event(2), event(3))
    for _ in range(2):
        refresh_day(changed, day(2), database, [name])
    projects = {(row.stat_date, row.project_name) for row in stored(spark, database, name).collect()}
    assert projects == {(day(n), project) for n in (1, 2, 3) for project in ("all", "alpha")}


def test_full_refresh_replaces_everything_from_the_floor_on(spark, database):
    name = "flow_summary_bydate"
    refresh_day(log_of(spark, event(40)), day(40), database, [name])
    log = log_of(spark, event(-400), event(1), event(3), event(5))
    refresh_full(log, database, [name], today=day(4))
    assert {row.stat_date for row in stored(spark, database, name).collect()} == {day(1), day(3)}
    refresh_full(log.filter("false"), database, [name], today=day(4))
    assert stored(spark, database, name).count() == 0


def test_a_failing_full_refresh_keeps_the_old_rows(spark, database):
    name = "flow_summary_bydate"
    refresh_full(log_of(spark, event(1), event(2)), database, [name], today=day(4))
    before = spark_rows(stored(spark, database, name))
    broken = log_of(spark, event(1), event(3)).withColumn("client_ip", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        refresh_full(broken, database, [name], today=day(4))
    assert spark_rows(stored(spark, database, name)) == before


def test_a_day_that_comes_out_empty_is_removed(spark, database):
    name = "flow_summary_bydate"
    refresh_days(log_of(spark, event(1), event(2), event(3)), day(1), day(3), database, [name])
    refresh_day(log_of(spark, event(1), event(3)), day(2), database, [name])
    assert {row.stat_date for row in stored(spark, database, name).collect()} == {day(1), day(3)}


def test_reports_of_one_plan_are_written_to_each_table(spark, database):
    names = ("flow_trend_bydate", "visitor_detail_bydate", "channel_detail_bydate")
    refresh_day(log_of(spark, event(1)), day(1), database, names)
    first = spark_rows(stored(spark, database, names[0]))
    assert first
    assert all(spark_rows(stored(spark, database, name)) == first for name in names[1:])
    assert set(spark.table(f"{database}.{names[0]}").columns) == {*STD, *WITH_NEW, "update_time"}


def test_keeping_the_log_gives_the_same(spark, database):
    log = log_of(spark, *EVENTS)
    names = ("flow_summary_bydate", "visitor_life_bydate", "flow_summary_byhour")
    refresh_days(log, day(8), day(10), database, names, keep=StorageLevel.MEMORY_AND_DISK)
    for name in names:
        wanted = spark_rows(report(name, log, day(8), day(10)))
        assert wanted
        assert difference(spark_rows(stored(spark, database, name)), wanted) == ""


def test_dates_are_checked(spark):
    with pytest.raises(ValueError, match="before"):
        refresh_days(log_of(spark), date(2024, 1, 2), date(2024, 1, 1), "nowhere")


def test_page_report_starts_later(spark):
    assert REPORTS["visituri_detail_bydate"].floor == date(2023, 10, 1)
    assert {REPORTS[name].floor for name in REPORTS if name != "visituri_detail_bydate"} == {date(2023, 1, 1)}
