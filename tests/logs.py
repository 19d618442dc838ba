"""Literal event logs."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from footfall.model import LOG_SCHEMA
from oracle.reports import LOG

START = datetime(2024, 1, 1)
DEFAULTS = {
    "lib": "js",
    "event": "$pageview",
    "project_name": "alpha",
    "is_first_day": "false",
    "distinct_id": "u1",
    "event_session_id": "s1",
    "country": "China",
    "province": "Beijing",
    "city": "Beijing",
    "manufacturer": "Apple",
    "client_ip": "10.0.0.1",
    "url": "https://a.b/c",
    "url_path": "/c",
    "title": "C",
    "latest_referrer_host": "r.example",
    "latest_search_keyword": "word",
}


def day(number: int) -> date:
    """Day 1 is the first of January."""
    return (START + timedelta(days=number - 1)).date()


def event(day_number: int, clock: str = "10:00:00", **values: str) -> dict:
    """One event; `clock` is HH:MM:SS, other columns default to ordinary values."""
    hours, minutes, seconds = (int(part) for part in clock.split(":"))
    at = START + timedelta(days=day_number - 1, hours=hours, minutes=minutes, seconds=seconds)
    return {"stat_date": at.date(), "stat_hour": f"{hours:02d}", "log_time": at, **DEFAULTS, **values}


def log_of(spark: SparkSession, *events: dict) -> DataFrame:
    return spark.createDataFrame([tuple(one[name] for name in LOG_SCHEMA.names) for one in events], LOG_SCHEMA)


def duckdb_over_log(events: list[dict]) -> duckdb.DuckDBPyConnection:
    """A connection in which `on_log` texts run over these events."""
    connection = duckdb.connect()
    table = pa.table({name: [one[name] for one in events] for name in LOG_SCHEMA.names})
    connection.register("literal_log", table)
    connection.execute("CREATE TABLE event_log AS SELECT * FROM literal_log")
    return connection


def on_log(sql: str) -> str:
    return sql.replace(LOG, "log AS (SELECT * FROM event_log)")


def random_events(seed: int, rows: int, days: int = 14) -> list[dict]:
    """Few values per column, so that everything meets everything, and one session and visitor in a third of all rows."""
    chance = random.Random(seed)
    choices = {
        "lib": ["js", "iOS", "Android", "MiniProgram", "", "Other", "N/A"],
        "event": ["$pageview", "$AppViewScreen", "$MPViewScreen", "$WebClick", ""],
        "project_name": ["alpha", "beta", "", "N/A"],
        "is_first_day": ["true", "false", ""],
        "distinct_id": ["u1", "u2", "u3", "u4", ""],
        "event_session_id": ["s1", "s2", "s3", "s4", "s5", ""],
        "country": ["China", "", "N/A"],
        "province": ["Beijing", "Zhejiang", ""],
        "city": ["c1", "c2", ""],
        "manufacturer": ["Apple", "", "N/A"],
        "client_ip": ["10.0.0.1", "10.0.0.2", "", "N/A"],
        "url": ["https://a.b/c", "https://a.b:80/d?x=1 2", "pages/index", "", "url的domain解析失败", "N/A"],
        "url_path": ["/c", "/d", ""],
        "title": ["C", "D", ""],
        "latest_referrer_host": ["r.example", "", "url的domain解析失败", "取值异常", "N/A"],
        "latest_search_keyword": ["word", "other", "", "未取到值", "N/A"],
    }
    events = []
    for _ in range(rows):
        values = {name: chance.choice(options) for name, options in choices.items()}
        if chance.random() < 0.33:
            values["event_session_id"], values["distinct_id"] = "hot", "everyone"
        moment = f"{chance.randrange(24):02d}:{chance.choice((0, 1)):02d}:{chance.choice((0, 10, 30)):02d}"
        events.append(event(chance.randint(1, days), moment, **values))
    return events
