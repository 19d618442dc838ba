"""Compare Spark and SQL results as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("events", "pages", "documents", "embeddings", "benchmark")


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def spark_rows(rows: DataFrame) -> Counter:
    names = sorted(rows.columns)
    table = rows.select(*names).toArrow()
    return Counter(zip(*(column.to_pylist() for column in table.columns), strict=True))


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = [names.index(name) for name in sorted(names)]
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())


def difference(found: Counter, wanted: Counter, limit: int = 5) -> str:
    """'' when equal, else a few rows of either side."""
    extra, missing = found - wanted, wanted - found
    if not extra and not missing:
        return ""
    return (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(wanted.values())}:"
        f" extra {list(extra)[:limit]} missing {list(missing)[:limit]}"
    )
