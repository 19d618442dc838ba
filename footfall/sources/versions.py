"""Tables by day whose days are replaced as a whole, by whoever began last.

A versioned table is three things in the catalog. `<table>__rows` holds the rows of every write, partitioned by day and version.
`<table>__commits` says which days a version stands for; adding a version's partition to it is the one step that makes the write
count, for all its days at once. `<table>` is a view: of each day, the rows of its newest committed version.

Versions are the times at which their writers began to read, so of two that overlap the one that began later wins, whichever ends
first. A write that fails before its commit is never seen. A version that stands for everything hides all older rows, also
those whose older writer commits afterwards. Readers see a day before or after a commit, never in between.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "stat_date"
VERSION = "version"


def new_version() -> int:
    """Nanoseconds since 1970; clocks of drivers that write the same table should agree."""
    return time.time_ns()


def rows_table(table: str) -> str:
    return f"{table}__rows"


def commits_table(table: str) -> str:
    return f"{table}__commits"


def create(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """The empty table for rows like `rows`, where it isn't there yet. The day is its last column."""
    if spark.catalog.tableExists(table):
        return
    columns = [field for field in rows.schema.fields if field.name != DAY]
    listed = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {rows_table(table)} ({listed}, {DAY} DATE, {VERSION} BIGINT) USING parquet PARTITIONED BY ({DAY}, {VERSION})")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {commits_table(table)} ({DAY} DATE, {VERSION} BIGINT) USING parquet PARTITIONED BY ({VERSION})")
    # A null day stands for everything.
    newest = (
        f"SELECT {DAY} AS day, max({VERSION}) AS newest FROM {commits_table(table)} WHERE {DAY} IS NOT NULL GROUP BY {DAY}"
        f" HAVING max({VERSION}) >= coalesce((SELECT max({VERSION}) FROM {commits_table(table)} WHERE {DAY} IS NULL), 0)"
    )
    shown = ", ".join([*(f"r.{field.name}" for field in columns), f"r.{DAY}"])
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {shown} FROM {rows_table(table)} r"
        f" JOIN ({newest}) c ON r.{DAY} = c.day AND r.{VERSION} = c.newest"
    )


def write(rows: DataFrame, table: str, version: int, order: Sequence[str] = ()) -> None:
    """Put the rows of `version` beside what is there; they are not seen before `commit`.

    The rebalancing hint brings the rows of a day together and lets adaptive execution split a large day, so there is neither one
    file per task and day nor one huge file. `order` sorts the rows of a file, so that readers skip row groups.
    """
    create(rows.sparkSession, table, rows)
    ordered = [*(name for name in rows.columns if name != DAY), DAY]
    dealt = rows.select(*ordered, F.lit(version).cast("long").alias(VERSION)).hint("rebalance", DAY)
    if order:
        dealt = dealt.sortWithinPartitions(DAY, *order)
    dealt.write.insertInto(rows_table(table))


def commit(spark: SparkSession, table: str, version: int, days: Sequence[date], everything: bool = False) -> None:
    """Make `version` stand for `days`, with rows or without; with `everything`, also for all days that it does not have."""
    told = [(one,) for one in days] + ([(None,)] if everything else [])
    found = spark.createDataFrame(told, f"{DAY} date").coalesce(1)
    found.select(DAY, F.lit(version).cast("long").alias(VERSION)).write.insertInto(commits_table(table))


def written_days(spark: SparkSession, table: str, version: int) -> list[date]:
    """The days of which `version` has rows, from the catalog."""
    return sorted(day for day, of in partitions(spark, rows_table(table)) if of == version)


def committed_days(spark: SparkSession, table: str, first: date, last: date) -> set[date]:
    """The days first..last that a version stands for, with rows or without."""
    if not spark.catalog.tableExists(table):
        return set()
    commits = spark.table(commits_table(table))
    whole = commits.filter(f"{DAY} IS NULL").agg(F.coalesce(F.max(VERSION), F.lit(0)).alias("whole")).first()["whole"]
    known = commits.filter((F.col(VERSION) >= whole) & F.col(DAY).between(first, last)).select(DAY).distinct()
    return {row[DAY] for row in known.collect()}  # no more than days asked for


def partitions(spark: SparkSession, table: str) -> list[tuple[date | None, int | None]]:
    """(day, version) of the table's partitions, from the catalog: no file is read."""
    found = []
    for (text,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in text.split("/"))
        named = values.get(DAY)
        found.append((date.fromisoformat(named) if named and named[0].isdigit() else None, int(values[VERSION]) if VERSION in values else None))
    return found


def drop_replaced(spark: SparkSession, table: str, older_than: timedelta = timedelta(days=2)) -> int:
    """Drop the rows of versions begun before `older_than` ago that are not the newest of their day; how many partitions went.

    Leave readers and writers the time they need: a read of an old version that is under way fails when its files go.
    """
    limit = new_version() - int(older_than.total_seconds() * 1e9)
    commits = spark.table(commits_table(table))
    whole = commits.filter(f"{DAY} IS NULL").agg(F.coalesce(F.max(VERSION), F.lit(0)).alias("whole")).first()["whole"]
    newest = {row[DAY]: row["newest"] for row in commits.groupBy(DAY).agg(F.max(VERSION).alias("newest")).collect()}
    dropped = 0
    for day, version in partitions(spark, rows_table(table)):
        if version < limit and not (newest.get(day) == version and version >= whole):
            spark.sql(f"ALTER TABLE {rows_table(table)} DROP IF EXISTS PARTITION ({DAY} = DATE'{day}', {VERSION} = {version})")
            dropped += 1
    return dropped
