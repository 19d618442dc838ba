"""Run every query against its SQL: ``python -m tests.compare_all [folder] [query ...]``."""

from __future__ import annotations

import sys
import time

from __spark_entry__ import oracle_sql, queries
from footfall.session import local_session
from tests.comparing import difference, duckdb_over, spark_rows, sql_rows


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    connection = duckdb_over(folder)
    run, sql = queries(), oracle_sql()
    failed = 0
    for name in names or run:
        started = time.monotonic()
        rows = run[name](spark, folder)
        found = spark_rows(rows)
        spark_seconds = time.monotonic() - started
        if name not in sql:
            print(f"{name}: {sum(found.values())} rows, {spark_seconds:.1f}s no SQL", flush=True)
            continue
        columns, wanted = sql_rows(connection, sql[name])
        told = difference(found, wanted) or ("" if columns == sorted(rows.columns) else f"columns {columns}")
        failed += bool(told)
        print(f"{name}: {sum(wanted.values())} rows, {spark_seconds:.1f}s {told or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
