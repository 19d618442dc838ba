"""Every query equals its SQL: over the given tables, and over logs full of odd values."""

from __future__ import annotations

import pytest

from __spark_entry__ import as_text, oracle_sql, queries
from footfall import REPORTS, report
from footfall.plans.parts import PARTS, part
from footfall.plans.refreshed import BLANK, LAST_DAY, REFRESHED
from tests.comparing import difference, duckdb_over, spark_rows, sql_rows
from tests.logs import duckdb_over_log, log_of, on_log, random_events

FOLDER = "/root/testdata/sf0.001"
ODD_EVENTS = random_events(seed=7, rows=240)


@pytest.fixture(scope="module")
def given():
    return duckdb_over(FOLDER)


@pytest.fixture(scope="module")
def odd():
    return duckdb_over_log(ODD_EVENTS)


NAMES = (*REPORTS, *PARTS)
STORED = (*REFRESHED, *(f"last_day_{name}" for name in LAST_DAY), *(f"blank_{name}" for name in BLANK))


def test_every_query_has_its_sql():
    assert {*NAMES, *STORED} <= queries().keys() & oracle_sql().keys()


@pytest.mark.parametrize("name", (*NAMES, *STORED))
def test_given_tables(spark, given, name):
    rows = queries()[name](spark, FOLDER)
    columns, wanted = sql_rows(given, oracle_sql()[name])
    assert sorted(rows.columns) == columns
    assert wanted
    assert difference(spark_rows(rows), wanted) == ""


@pytest.mark.parametrize("name", NAMES)
def test_odd_values(spark, odd, name):
    log = log_of(spark, *ODD_EVENTS)
    rows = as_text(part(name, log) if name in PARTS else report(name, log))
    _, wanted = sql_rows(odd, on_log(oracle_sql()[name]))
    assert wanted
    assert difference(spark_rows(rows), wanted) == ""
