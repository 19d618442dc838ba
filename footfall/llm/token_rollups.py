"""Token counts as delta-maintained rollups.

A rollup holds totals by source, language and tokenizer version. Inserts add a document and its tokens, deletes take them away, revised
counts add the difference. A commit sums up its batch, compares it with what the totals already have of a batch of that name, and adds
the difference: totals are never summed up anew from all batches. Committing a batch again changes nothing.

Every commit writes one new state, totals and the sums of the newest batches together, and then one row that makes it the current one. A
commit that fails in between leaves the state before it.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import stored

KEYS = ("source", "lang", "tokenizer_version")
#: Rows of a state: with `kind` total a group's totals, with batch what one batch added to it, with name a batch that the totals contain.
STATE = "kind string, batch string, number long, source string, lang string, tokenizer_version string, documents long, tokens long"
COMMITS = "seq long, state string"
#: Sums of so many of the newest batches are kept by themselves, so that those can be committed anew with other rows.
OPEN_BATCHES = 64
#: A state holds groups, not documents: few files.
FILES = 8


@lru_cache
def _encoding(path: str, pattern: str):
    import tiktoken

    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}
    return tiktoken.Encoding(Path(path).stem, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(
    rows: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: doc_id, tokens, and the columns of `keep`. Null texts have no tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(text.as_py() or "")) for text in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([counts, *batch.columns[1:]], names=["tokens", *batch.schema.names[1:]])

    chosen = rows.select(F.col(text_column).cast("string").alias("text"), F.col(id_column).cast("long").alias("doc_id"), *keep)
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in chosen.schema.fields[1:])
    return chosen.mapInArrow(count, f"tokens long, {kinds}")


def inserts(rows: DataFrame) -> DataFrame:
    """Deltas of new documents, rows of the keys and tokens."""
    return rows.select(*KEYS, F.lit(1).alias("documents"), F.col("tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Deltas of documents that are gone, with the tokens they were counted with."""
    return rows.select(*KEYS, F.lit(-1).alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(rows: DataFrame, before: str, after: str) -> DataFrame:
    """Deltas of documents that are counted anew."""
    change = F.coalesce(F.col(after), F.lit(0)) - F.coalesce(F.col(before), F.lit(0))
    return rows.select(*KEYS, F.lit(0).alias("documents"), change.alias("tokens"))


class Rollup:
    """A rollup in a folder that all executors reach. One job at a time may commit; a second one beside it is noticed and raises."""

    def __init__(self, spark: SparkSession, folder: str, open_batches: int = OPEN_BATCHES) -> None:
        self.spark, self.folder, self.open_batches = spark, folder.rstrip("/"), open_batches
        # The first rows of the list of commits, where there is none yet: no state.
        spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(f"{self.folder}/commits")

    def _current(self) -> tuple[int, DataFrame]:
        """Number and rows of the newest committed state."""
        commits = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits")
        last = commits.groupBy("seq").agg(F.collect_set("state").alias("states")).orderBy(F.desc("seq")).limit(1).collect()
        if not last:
            return 0, self.spark.createDataFrame([], STATE)
        if len(last[0]["states"]) > 1:
            raise RuntimeError(f"two jobs committed to {self.folder} at once: {sorted(last[0]['states'])}")
        return last[0]["seq"], self.spark.read.schema(STATE).parquet(f"{self.folder}/states/{last[0]['states'][0]}")

    def commit(self, batch: str, deltas: DataFrame) -> None:
        """Make `deltas` the content of `batch`, in place of what was committed under that name, also where there are no rows now.

        Null keys are a group of their own; null tokens count as 0. Beyond the newest `open_batches` batches only the names are kept:
        committing one of those again changes nothing, whatever rows it has.
        """
        seq, state = self._current()
        names = {r["batch"]: r["number"] for r in state.filter("kind = 'name'").select("batch", "number").collect()}
        oldest = max(names.values(), default=-1) - self.open_batches
        if names.get(batch, oldest + 1) <= oldest:
            return
        number = names.get(batch, max(names.values(), default=-1) + 1)
        oldest = max([number, *names.values()]) - self.open_batches
        new = deltas.groupBy(*KEYS).agg(
            F.coalesce(F.sum("documents"), F.lit(0)).cast("long").alias("documents"),
            F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"),
        )
        # Summed up once, for the batch's own rows and for the totals.
        own = new.select(F.lit("batch").alias("kind"), F.lit(batch).alias("batch"), F.lit(number).cast("long").alias("number"), *KEYS, "documents", "tokens")
        own = stored(own)
        before = state.filter((F.col("kind") == "batch") & (F.col("batch") == batch))
        others = state.filter(F.col("kind") == "batch").filter((F.col("batch") != batch) & (F.col("number") > oldest))
        # Only totals, one batch before and the same after are added up, however many batches there were.
        changes = own.unionByName(before.withColumns({c: -F.col(c) for c in ("documents", "tokens")}))
        totals = (
            state.filter("kind = 'total'")
            .unionByName(changes)
            .groupBy(*KEYS)
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
            .filter("documents <> 0 OR tokens <> 0")
            .select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("batch"), F.lit(None).cast("long").alias("number"), *KEYS, "documents", "tokens")
        )
        kept = state.filter((F.col("kind") == "name") & (F.col("batch") != batch))
        named = self.spark.createDataFrame([("name", batch, number, None, None, None, 0, 0)], STATE)
        rows = totals.unionByName(own).unionByName(others).unionByName(kept).unionByName(named)
        name = uuid.uuid4().hex
        rows.coalesce(FILES).write.parquet(f"{self.folder}/states/{name}")
        self._mark(seq + 1, name)

    def _mark(self, seq: int, name: str) -> None:
        """Make the state `name` the current one: a row more in the list of commits."""
        self.spark.createDataFrame([(seq, name)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")

    def totals(self) -> DataFrame:
        """Documents and tokens of every group that has any, as the last commit left them."""
        return self._current()[1].filter("kind = 'total'").select(*KEYS, "documents", "tokens")
