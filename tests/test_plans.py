"""Shape of the physical plans: what scales with the log must not multiply or gather."""

from __future__ import annotations

import re

import pytest

from footfall import REPORTS, report
from footfall.sources.log import event_log
from tests.comparing import difference, spark_rows
from tests.logs import day, event, log_of, random_events


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A log stored by day, as a cluster has it."""
    path = str(tmp_path_factory.mktemp("log") / "events")
    log_of(spark, *(event(number) for number in range(1, 21))).write.partitionBy("stat_date").parquet(path)
    return spark.read.parquet(path)


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().explainString(
        rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_join_no_python_no_single_task(table, name):
    plan = plan_of(report(name, table))
    for gathering in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python", "ObjectHashAggregate"):
        if gathering == "SinglePartition" and name == "visitor_life_bydate":
            continue  # the last day of the log, a single value
        assert gathering not in plan, gathering


@pytest.mark.parametrize("name", REPORTS)
def test_refresh_reads_only_its_days(table, name):
    plan = plan_of(report(name, table, day(12), day(12)))
    scans = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan)
    assert scans
    for scan in scans:
        if re.search(rf"stat_date#\d+ = {day(12)}", scan):
            continue
        lower = re.search(r"stat_date#\d+ >= (\d{4}-\d\d-\d\d)", scan)
        assert lower and lower[1] in {str(day(12)), str(day(12 - 7)), str(day(12 - 3))}, scan
        assert re.search(rf"stat_date#\d+ <= {day(12)}", scan), scan


def test_scans_read_only_needed_columns(table):
    for scan in re.findall(r"ReadSchema: struct<(.*?)>\n", plan_of(report("area_summary_bydate", table))):
        assert {column.split(":")[0] for column in scan.split(",")} == {
            "event", "lib", "project_name", "country", "province",
        }


def test_copies_per_grouping_set_are_merged_before_they_are_shuffled(table):
    """No visitor's tuples meet in a window; the copies are merged by visitor on the map side of their shuffle."""
    plan = report("flow_trend_bydate", table)._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    assert not [line for line in lines if line.startswith("Window") and "min(" in line]
    words = [line.split()[0].split("(")[0] for line in lines if line]
    joined = next(i for i, word in enumerate(words) if word in ("SortMergeJoin", "BroadcastHashJoin"))
    above = [word for word in words[:joined] if word in ("Exchange", "Generate", "HashAggregate", "Union")]
    assert above[above.index("Union") + 1 :] == ["HashAggregate", "Exchange", "HashAggregate", "Generate"]


def test_single_day_visits_shuffle_once(table):
    whole, single = (plan_of(report("user_visit_bydate", table, first, day(12))) for first in (day(1), day(12)))
    assert "lag(" in whole
    assert "lag(" not in single


def test_full_level_rows_are_merged_before_they_are_copied(table):
    """Page views are summed per dimension tuple first; the copies per grouping set follow that shuffle."""
    plan = report("area_summary_bydate", table)._jdf.queryExecution().executedPlan().toString()
    words = [line.strip(" :+-*()0123456789").split("(")[0].split()[0] for line in plan.splitlines()[1:]]
    shape = [word for word in words if word in ("Exchange", "Generate", "HashAggregate", "FileScan")]
    merged, copied = ["HashAggregate", "Exchange", "HashAggregate"], ["Generate"]
    assert shape == [*merged, *copied, *merged, "FileScan"]


def test_two_histograms_share_their_visits(table):
    """Both from one plan: the shuffles of one histogram, not of two."""
    exchanges = lambda rows: rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    alone = [exchanges(report(name, table)) for name in ("user_visit_bydate", "user_visittime_bydate")]
    shared = {REPORTS[name].shared for name in ("user_visit_bydate", "user_visittime_bydate")}
    assert len(shared) == 1
    assert exchanges(shared.pop()(event_log(table), None, None)) == alone[0] == alone[1]


def test_two_histograms_equal_each_alone(spark):
    log = log_of(spark, *random_events(seed=41, rows=250)).cache()
    both = REPORTS["user_visit_bydate"].shared(event_log(log), day(3), day(12)).cache()
    for name in ("user_visit_bydate", "user_visittime_bydate"):
        assert difference(spark_rows(both.select(*REPORTS[name].columns)), spark_rows(report(name, log, day(3), day(12)))) == ""
