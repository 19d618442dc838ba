"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut into chunks where its own content says so. Equal texts get equal chunks, and a chunk that many texts share
is looked at once. A chunk goes by its 64-bit fingerprint; fingerprints are verified against the chunks themselves, and where two
different chunks share one, a variant number tells them apart. Texts are then compared by their recipes, the lists of
chunk identifiers: a few numbers per document instead of its text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

LEAST_CHUNK = 256
MOST_CHUNK = 4096


def _drawn(first: int = 0x0300, last: int = 0xD7FF) -> str:
    """A class of one character in sixteen of the scripts beyond Latin: those whose code point modulo 64 is below 4."""
    return "".join(f"\\u{at:04X}-\\u{at + 3:04X}" for at in range(first, last, 64))


#: A chunk ends after a sentence mark or line end, after a word of certain endings, or in scripts beyond Latin after a drawn character;
#: at the latest after MOST_CHUNK characters, or where the text ends.
_ENDS = rf"[\n.!?;。！？]|[bdghkmpw]\s|(?=[^\x00-\u02FF])[{_drawn()}]"
CHUNK = rf"(?s).{{{LEAST_CHUNK},{MOST_CHUNK}}}?(?:(?<={_ENDS})|\z)|.{{1,{MOST_CHUNK}}}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order, none longer than MOST_CHUNK; joined they are the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def exact_duplicates(
    rows: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of `rows`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after `normalise` (by default nothing is changed); null counts as empty. Of equal
    texts the row with the largest id stays; rows repeated with that id count in `group_size`, one of them is kept.
    Null ids lose against others; among null ids alone, keep_id is null and one row is kept. An empty table gives no rows.
    """
    texts = rows.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(normalise(F.coalesce(F.col(text_column), F.lit(""))), F.lit("")).alias("text"),
    )
    cut = texts.select("doc_id", "text", chunks(F.col("text")).alias("chunks"))
    recipes = stored(
        cut.select(
            "doc_id",
            F.transform("chunks", lambda chunk: fingerprint(chunk)).alias("prints"),
            F.sha2("text", 256).alias("text_sha256"),
        )
    )
    # Map-side merged: a chunk of a thousand copies leaves each task once. The second shuffle has fingerprints only.
    pieces = cut.select(F.explode("chunks").alias("chunk")).select(fingerprint(F.col("chunk")).alias("print"), "chunk")
    doubtful = stored(pieces.distinct().groupBy("print").count().filter("count > 1").select("print"))
    if doubtful.isEmpty():
        recipes = recipes.withColumn("variants", F.lit(None).cast("array<int>"))
    else:
        recipes = _with_variants(cut, recipes, pieces, doubtful, fingerprint)

    # Only recipes that occur again are joined back; the rest keep themselves.
    recipe = ["prints", "variants"]
    groups = (
        recipes.groupBy(*recipe)
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    same = (F.col("r.prints") == F.col("g.prints")) & F.col("r.variants").eqNullSafe(F.col("g.variants"))
    joined = (
        recipes.alias("r")
        .join(groups.alias("g"), same, "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            "text_sha256",
        )
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    turn = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", (stays & (turn == 1)).alias("kept"), "text_sha256")


def _with_variants(
    cut: DataFrame, recipes: DataFrame, pieces: DataFrame, doubtful: DataFrame, fingerprint: Callable[[Column], Column]
) -> DataFrame:
    """Recipes in which chunks that share a fingerprint have different variant numbers."""
    shared = pieces.join(doubtful, "print", "left_semi").distinct()
    numbered = shared.select("print", "chunk", F.row_number().over(Window.partitionBy("print").orderBy("chunk")).alias("variant"))
    places = cut.select("text", F.posexplode("chunks").alias("place", "chunk"))
    places = places.select(F.sha2("text", 256).alias("text_sha256"), "place", "chunk", fingerprint(F.col("chunk")).alias("print"))
    found = (
        places.distinct()
        .join(numbered, ["print", "chunk"])
        .groupBy("text_sha256")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "variant"))), lambda x: x["variant"]).alias("variants"))
    )
    return recipes.join(found, "text_sha256", "left")
