"""Document fingerprints by spot signatures: chains of content words that follow common words.

Wherever a common word (an anchor) stands, it and the next content words make a signature. Common words come everywhere in running
text but rarely in menus and lists, so the signatures follow the prose; an edit changes only the signatures around it. The
fingerprint of a text is the set of its signatures, written as their sorted codes. Fingerprints are compared by the Jaccard
similarity of the sets; sets whose lengths are too unlike are told apart without looking at them.

A fingerprint of the text as edited needs the document that follows by id: rows are dealt out by ranges of ids, and the
first row of each range goes along to the range before it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The commonest function words of English, German, French and Spanish; A-Z in lower case.
ANCHORS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "this", "are", "at", "from",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "dem", "ein", "eine", "als",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "par", "qui", "dans", "avec", "sur", "pas", "au",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "su", "una", "para", "es", "al", "lo",
)
#: Content words of a signature.
CHAIN = 3
#: Bytes of a signature's code.
CODE = 6
#: Similarity from which two documents count as near copies.
LEAST = 0.8
#: Rows looked at for the ends of the ranges, for each range.
DRAWN_PER_RANGE = 60
#: Rows whose results are sent back together.
ROWS_TOGETHER = 500
#: A-Z in lower case, other letters, digits and bytes beyond ASCII as they are, everything else a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_ANCHORS = frozenset(word.encode() for word in ANCHORS)
OUTPUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _code(parts: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(parts), usedforsecurity=False).digest()[:CODE]


def signatures(text: str, anchors: frozenset[bytes] = _ANCHORS, chain: int = CHAIN) -> set[bytes]:
    """Codes of the text's signatures.

    Words are runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased. A text without a whole chain has one signature, of all
    its words; one without words, of itself; the empty text has none.
    """
    words = text.encode().translate(_PLAIN).split()
    content: list[bytes] = []
    spots: list[tuple[bytes, int]] = []
    for word in words:
        if word in anchors:
            spots.append((word, len(content)))
        else:
            content.append(word)
    last = len(content) - chain
    found = {b" ".join((word, *content[at : at + chain])) for word, at in spots if at <= last}
    if found:
        md5 = hashlib.md5
        return {md5(each, usedforsecurity=False).digest()[:CODE] for each in found}
    if words:
        return {_code(words)}
    return {_code([b"", text.encode()])} if text else set()


def fingerprint(codes: set[bytes]) -> str:
    """The sorted codes as hexadecimal digits, one after the other."""
    return b"".join(sorted(codes)).hex()


def codes_of(printed: str) -> set[bytes]:
    data = bytes.fromhex(printed)
    return {data[at : at + CODE] for at in range(0, len(data), CODE)}


def likeness(left: set[bytes], right: set[bytes], least: float = 0.0) -> float:
    """Jaccard similarity, 1 for two empty sets. Below `least` it may be given as 0, without looking where the lengths say so."""
    few, many = sorted((len(left), len(right)))
    if few < least * many:
        return 0.0
    shared = len(left & right)
    return shared / (few + many - shared) if many else 1.0


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the text replaced by as many of the first code points of what follows, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _keyed(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id and text, with what breaks ties: a hash of the text, and the place where the row is read."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    chosen = rows.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    return chosen.select(
        "*",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("k"),
        F.xxhash64(F.coalesce(F.col("doc_id") * 0, F.lit(1)), "text").alias("h"),
        F.monotonically_increasing_id().alias("m"),
    )


def _range_of(ends: list[tuple[int, int, int]]):
    """Number of the range that holds a key: how many of `ends` are not above it."""
    first = np.array([end[0] for end in ends], np.int64)

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series, m: pd.Series) -> pd.Series:
        low, high = np.searchsorted(first, k, "left"), np.searchsorted(first, k, "right")
        found = high.copy()
        for i in np.flatnonzero(low < high):  # an end with this very id
            found[i] = bisect_right(ends, (k.iat[i], h.iat[i], m.iat[i]), low[i], high[i])
        return pd.Series(found, dtype="int32")

    return number("k", "h", "m")


def followed(rows: DataFrame, ranges: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text, extra) in `ranges` partitions in order of id, each ended by a row with `extra`: the one that follows it.

    After the last row of all comes the first. Rows without id stand first, rows of one id in order of a hash of their text.
    Only keys are looked at on the driver: a sample of bounded size for the ends of the ranges, and the first row of each.
    """
    keyed = _keyed(rows, id_column, text_column)
    keys = keyed.select("k", "h", "m")
    wanted = ranges * DRAWN_PER_RANGE
    share = min(1.0, 1.2 * wanted / max(1, keys.count()))
    drawn = sorted(tuple(row) for row in (keys if share == 1.0 else keys.sample(share, seed=1)).collect())
    ends = [drawn[len(drawn) * i // ranges] for i in range(1, ranges)] if drawn else []
    numbered = keyed.withColumn("number", _range_of(ends)) if ends else keyed.withColumn("number", F.lit(0))
    heads = sorted(
        (row["number"], row["head"]["k"], row["head"]["h"])
        for row in numbered.select("number", "k", "h").groupBy("number").agg(F.min(F.struct("k", "h")).alias("head")).collect()
    )  # one a range
    goes = [(k, h, heads[i - 1][0]) for i, (_, k, h) in enumerate(heads)]
    first = rows.sparkSession.createDataFrame(goes, "k long, h long, number int")
    extra = (
        keyed.join(F.broadcast(first), ["k", "h"])
        .groupBy("number")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        .selectExpr("doc_id", "text", "0L AS k", "0L AS h", "0L AS m", "number", "true AS extra")
    )
    both = numbered.withColumn("extra", F.lit(False)).unionByName(extra)
    return both.repartitionById(ranges, "number").sortWithinPartitions("extra", "k", "h", "m").select("doc_id", "text", "extra")


def fingerprints_after_edit(rows: DataFrame, ranges: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the row's with its last half replaced by the beginning of the row that follows by id, after the last the
    first. near_edited compares its fingerprint with that of the edited text, near_next with that of the next row. Null texts are
    empty. Rows without id stand before all others; rows sharing an id follow one another in order of a hash of their text. The row
    of a table with one row follows itself. No rows, no result.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int | None, str, set[bytes]] | None = None
        ended = False
        names = [part.split()[0] for part in OUTPUT.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_TOGETHER):
                part = batch.slice(at, ROWS_TOGETHER)
                out: list[list] = [[], [], [], [], [], [], []]
                for doc_id, text, last in zip(*(column.to_pylist() for column in part.columns), strict=True):
                    mine = (doc_id, text, signatures(text))
                    if before is not None:
                        changed = edited(before[1], text)
                        codes = before[2] if changed == before[1] else signatures(changed)
                        row = (
                            before[0],
                            len(before[1]),
                            hashlib.sha256(changed.encode()).hexdigest(),
                            fingerprint(before[2]),
                            fingerprint(codes),
                            likeness(before[2], codes),
                            likeness(before[2], mine[2]),
                        )
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                    before, ended = mine, last
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
        if before is not None and not ended:
            raise RuntimeError("a range of ids without the row that follows it: the table was read in another order")

    return followed(rows, ranges, id_column, text_column).mapInArrow(compare, OUTPUT)
