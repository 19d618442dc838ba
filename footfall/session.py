"""Session settings the reports are tuned for; every one can be overridden by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans are long; recording the Python line of every expression costs as much as building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Beyond 8000 bytes the JVM interprets a generated method; Spark then does better without it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cpus: int, *, shuffle_partitions: int | None = None, memory: str = "8g", **settings: str) -> SparkSession:
    """A session on this machine, for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("footfall")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
