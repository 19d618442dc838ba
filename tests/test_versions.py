"""Overlapping and failing refreshes, cells kept by day, and what a refresh reads."""

from __future__ import annotations

import re
from datetime import timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from footfall import REPORTS, refresh_day, refresh_days, refresh_full, report
from footfall.operators.cells import PAGE_CELLS, SESSION_CELLS
from footfall.plans import report as plan_of_report
from footfall.refresh import store
from footfall.sources import versions
from footfall.sources.log import earliest_partition
from tests.comparing import difference, spark_rows
from tests.logs import day, event, log_of, random_events
from tests.test_plans import plan_of
from tests.test_refresh import database  # noqa: F401

ROWS = "n int, stat_date date"


def rows(spark, *values):
    return spark.createDataFrame([(n, day(number)) for number, n in values], ROWS)


def shown(spark, table):
    return sorted((row["stat_date"], row["n"]) for row in spark.table(table).collect())


@pytest.mark.parametrize("later_ends_first", [False, True])
@pytest.mark.parametrize("full", [False, True])
def test_of_overlapping_writes_the_one_that_began_later_stays(spark, database, later_ends_first, full):  # noqa: F811
    """An old refresh of days 1 to 3 and a newer one of day 2, whichever commits first; and the other way round with a full one."""
    table = f"{database}.t"
    old, new = versions.new_version(), versions.new_version()
    ends = [
        partial(store, rows(spark, (1, 10), (2, 10), (3, 10)), table, [day(1), day(2), day(3)], old, full),
        partial(store, rows(spark, (2, 20)), table, [day(2)], new),
    ]
    for end in reversed(ends) if later_ends_first else ends:
        end()
    assert shown(spark, table) == [(day(1), 10), (day(2), 20), (day(3), 10)]
    # A newer full refresh without days 1 and 4 hides them, also where an older write commits after it.
    late, whole = versions.new_version(), versions.new_version()
    store(rows(spark, (2, 30), (3, 30)), table, [day(2), day(3)], whole, everything=True)
    store(rows(spark, (4, 25)), table, [day(4)], late)
    assert shown(spark, table) == [(day(2), 30), (day(3), 30)]
    assert versions.committed_days(spark, table, day(1), day(5)) == {day(2), day(3)}


def test_rows_without_a_commit_are_never_seen_and_old_versions_can_go(spark, database):  # noqa: F811
    table = f"{database}.t"
    store(rows(spark, (1, 1), (2, 1)), table, [day(1), day(2)])
    versions.write(rows(spark, (1, 9)).withColumn("update_time", F.current_timestamp()), table, versions.new_version())
    store(rows(spark, (2, 2)), table, [day(2)])
    assert shown(spark, table) == [(day(1), 1), (day(2), 2)]
    assert versions.drop_replaced(spark, table) == 0  # too young
    assert versions.drop_replaced(spark, table, timedelta(seconds=-1)) == 2
    assert shown(spark, table) == [(day(1), 1), (day(2), 2)]
    store(rows(spark), table, [day(1), day(2)])
    assert shown(spark, table) == []


def test_days_one_by_one_read_only_their_own_day_of_the_log(spark, database):  # noqa: F811
    """Each run is given a log without any other day, a day is run again, and all is as if reported over the whole log."""
    events = random_events(seed=5, rows=260, days=30)
    log = log_of(spark, *events).cache()
    names = ("visitor_life_bydate", "user_visit_bydate")
    refresh_days(log.filter(f"stat_date <= '{day(23)}'"), day(1), day(23), database, names)
    for number in (24, 25, 26, 25, 27, 28, 29, 30):
        refresh_day(log.filter(f"stat_date = '{day(number)}'"), day(number), database, names)
    for name in names:
        stored = spark.table(f"{database}.{name}").drop("update_time")
        wanted = report(name, log, day(1), day(30))
        assert difference(spark_rows(stored), spark_rows(wanted)) == "", name


def test_all_reports_of_a_refresh_come_from_two_passes_over_the_log(spark, database):  # noqa: F811
    events = random_events(seed=6, rows=60, days=9)
    log = log_of(spark, *events)
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    watched = log.mapInArrow(counted, log.schema)
    refresh_days(watched, day(8), day(9), database)
    assert passed.value == 2 * len(events)
    for name in REPORTS:
        stored = spark.table(f"{database}.{name}").drop("update_time")
        assert difference(spark_rows(stored), spark_rows(report(name, log, day(8), day(9)))) == "", name


def test_a_kept_look_back_is_not_read_again(spark, database, tmp_path):  # noqa: F811
    log_of(spark, *(event(number) for number in range(1, 13))).write.partitionBy("stat_date").parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    refresh_days(log, day(1), day(11), database, ["flow_summary_bydate"])
    scans = []
    written = versions.write
    try:
        versions.write = lambda cells, table, *more: (scans.append(plan_of(cells)) if table.endswith("_cells") else None, written(cells, table, *more))
        refresh_day(log, day(12), database, ["flow_summary_bydate"])
    finally:
        versions.write = written
    (plan,) = scans
    (filters,) = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan)
    assert f">= {day(12)}" in filters and f"<= {day(12)}" in filters


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "events")
    log_of(spark, *(event(number) for number in range(1, 4))).write.partitionBy("stat_date").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("searchword_detail_bydate", "latest_search_keyword"),
        ("visituri_detail_bydate", "url"),
        ("visitor_life_bydate", "event"),
        ("visitor_detail_bysession", "event_session_id"),
        ("user_visit_bydate", "event_session_id"),
        ("visitor_summary_byvisitor", "distinct_id"),
    ],
)
def test_filters_reach_the_scan(stored_log, name, pushed):
    filters = re.findall(r"PushedFilters: \[(.*?)\]\n", plan_of(plan_of_report(name, stored_log, day(1), day(3))))
    assert any(f"({pushed}" in one for one in filters), filters


def test_the_first_day_comes_from_the_catalog(spark, database, stored_log, tmp_path):  # noqa: F811
    spark.sql(f"CREATE TABLE {database}.log USING parquet PARTITIONED BY (stat_date) LOCATION '{tmp_path}/t' AS SELECT * FROM {{log}}", log=stored_log)
    # What the files say is gone: only the catalog knows the days.
    for file in tmp_path.glob("t/*/*.parquet"):
        file.write_bytes(b"no parquet")
    assert earliest_partition(spark, f"{database}.log", day(1)) == day(1)
    assert earliest_partition(spark, f"{database}.log", day(2)) == day(2)
    assert earliest_partition(spark, f"{database}.log", day(9)) is None
    spark.sql(f"CREATE TABLE {database}.flat USING parquet AS SELECT stat_date, lib FROM {{log}}", log=stored_log)
    assert earliest_partition(spark, f"{database}.flat", day(2)) == day(2)


def test_full_refresh_of_a_table_by_name(spark, database, stored_log):  # noqa: F811
    spark.sql(f"CREATE TABLE {database}.log USING parquet PARTITIONED BY (stat_date) AS SELECT * FROM {{log}}", log=stored_log)
    refresh_full(f"{database}.log", database, ["flow_summary_bydate"], today=day(2))
    assert {row["stat_date"] for row in spark.table(f"{database}.flow_summary_bydate").collect()} == {day(1), day(2)}


def test_cells_are_as_many_events_and_sort_what_filters_ask_for(spark):
    log = log_of(spark, *random_events(seed=8, rows=200)).cache()
    for cells in (SESSION_CELLS, PAGE_CELLS):
        merged = cells.of(log).cache()
        assert merged.agg(F.sum("events")).first()[0] == 200
        # Cells of cells are the same cells.
        assert difference(spark_rows(cells.of(merged)), spark_rows(merged)) == ""
