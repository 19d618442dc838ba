"""What the operators share: cutting lineage, SHA texts, block counts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what the context has.

    Only where neither is set and all runs on one machine, as in tests, a temporary folder is made. On a cluster that is an error:
    executors would write to their own disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="footfall-"))
    return context.getCheckpointDir().rstrip("/")


def stored(rows: DataFrame, compression: str = "snappy") -> DataFrame:
    """`rows` written to a table of their own in the shared folder, read again.

    Later steps start from that table: it outlives lost executors, and is read column by column.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/footfall-{uuid.uuid4().hex}"
    rows.write.parquet(path, compression=compression)
    return spark.read.schema(rows.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on the session sends whole texts to Python in batches of at most `rows`, fewer where it is set so.

    Ten thousand texts, the usual batch, stand in the JVM and in Python at once; a chain of operators in one session has no room for that.
    Results do not depend on it.
    """
    now = int(spark.conf.get(BATCH_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def blocks(rows: int, per_block: int) -> int:
    """Into how many blocks of about `per_block` so many rows go."""
    return max(1, -(-rows // per_block))
