"""Documents to packed sequences: language, exact copies, near copies, packing.

Every stage takes (spark, docs, sf_dir) and all that its predecessor kept. All but the last return the columns of documents.
Decisions go by doc_id: rows with a null id are never dropped as copies, and rows that share an id share its fate.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import small_batches, stored
from footfall.llm.exact_dedup import exact_duplicates
from footfall.llm.jaccard_join import jaccard_components
from footfall.llm.language_id import UNDETERMINED, predicted
from footfall.llm.packing import packed_documents
from footfall.llm.queries import held_out

#: The rows of run() need a trained network and a tokenizer.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is not in `dropped`. Written first, so that its size decides how it is joined."""
    return docs.join(stored(dropped.select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on; texts that are null or hold no letter go.

    Where no language can be learned, as without labels, only those go.
    """
    small_batches(spark)
    found = predicted(docs, training=~held_out())
    return _without(docs, found.filter((F.col("lang_pred") == UNDETERMINED) & ~F.col("letters")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, and one of rows that repeat it."""
    found = stored(exact_duplicates(docs))
    unique = _without(docs, found.filter("doc_id <> keep_id"))
    repeated = stored(found.filter("doc_id = keep_id AND NOT kept").select("doc_id").distinct())
    single = _without(unique, repeated)
    merged = unique.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return single.unionByName(merged)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by n-gram Jaccard links the one with the smallest doc_id stays."""
    small_batches(spark)
    return _without(docs, jaccard_components(docs).filter("doc_id <> component_id"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into sequences."""
    small_batches(spark)
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", language),
    ("exact dedup", exact_copies),
    ("n-gram jaccard", near_copies),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
