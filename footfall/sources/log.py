"""The event log as a DataFrame, and its day ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from footfall.model import LOG_SCHEMA

# A full rebuild starts no earlier than this; that of the page report, later.
EARLIEST_DAY = date(2023, 1, 1)
EARLIEST_PAGE_DAY = date(2023, 10, 1)


#: How many events a row stands for, and when the first and the last of them came.
EVENTS, STARTED, ENDED = "events", "started", "ended"
#: Before the name of a log column: the column as the table has it, so that a filter on it reaches the scan.
RAW = "raw_"


def event_log(table: DataFrame) -> DataFrame:
    """The log columns of `table`, missing texts read as ''; `table` holds events, or cells of events with some of the columns.

    `stat_date` passes through untouched, so day filters still prune partitions of the table. Texts also stay as they are, under
    RAW: conditions that neither a null nor '' meets are put on those.
    """
    merged = EVENTS in table.columns
    fields = [field for field in LOG_SCHEMA if not merged or field.name in table.columns]
    texts = [field.name for field in fields if isinstance(field.dataType, T.StringType)]
    others = [f"CAST({field.name} AS {field.dataType.simpleString()}) AS {field.name}" for field in fields if field.name not in texts]
    span = (EVENTS, STARTED, ENDED) if merged else (f"1L AS {EVENTS}", f"CAST(log_time AS TIMESTAMP_NTZ) AS {STARTED}", f"CAST(log_time AS TIMESTAMP_NTZ) AS {ENDED}")
    return table.selectExpr(*others, *(f"coalesce({name}, '') AS {name}" for name in texts), *(f"{name} AS {RAW}{name}" for name in texts), *span)


def day(value: date) -> str:
    return f"DATE'{value.isoformat()}'"


def between_days(rows: DataFrame, first: date | None, last: date | None, look_back: int = 0) -> DataFrame:
    """Rows of the days first..last and of `look_back` days before them; None leaves an end open."""
    if first is not None:
        rows = rows.filter(f"stat_date >= {day(first - timedelta(days=look_back))}")
    if last is not None:
        rows = rows.filter(f"stat_date <= {day(last)}")
    return rows


def earliest_day(log: DataFrame, floor: date = EARLIEST_DAY) -> date | None:
    """First day of the log that is not before `floor`; None if there is none."""
    return between_days(log, floor, None).selectExpr("min(stat_date)").first()[0]


def earliest_partition(spark: SparkSession, table: str, floor: date = EARLIEST_DAY) -> date | None:
    """The same for a table of the catalog: from its partitions where it has days as partitions, else from its rows."""
    if "stat_date" not in {column.name for column in spark.catalog.listColumns(table) if column.isPartition}:
        return earliest_day(spark.table(table), floor)
    days = (text.partition("stat_date=")[2].split("/")[0] for (text,) in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return min((found for found in (date.fromisoformat(text) for text in days if text[:1].isdigit()) if found >= floor), default=None)
