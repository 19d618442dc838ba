"""Ranks of rows by a composite key: a distributed radix sort from the least significant digit.

Every row has a position; positions are dealt into blocks. A pass looks at one digit of the key: how often each digit stands in each
block, summed up in order of digit and block, says where the first row of a digit in a block goes, and a stable counting sort
inside the block says where the others go. After the last pass the position is the rank. A block has a bounded number of rows and
a pass a bounded number of digits, whatever the keys; a value that a third of the rows share only makes one digit frequent.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

DIGIT_BITS = 10
#: Rows of a block, as a power of two.
BLOCK_BITS = 14
POSITION, BLOCK, DIGIT = "radix_position", "radix_block", "radix_digit"


def _digits(widths: Sequence[int], bits: int) -> list[list[tuple[int, int, int, int]]]:
    """For each pass the parts of its digit: (key, shift, mask, place). Keys come least significant first."""
    starts = np.cumsum([0, *widths])
    passes = []
    for low in range(0, int(starts[-1]), bits):
        parts = []
        for key, width in enumerate(widths):
            first, last = max(low, int(starts[key])), min(low + bits, int(starts[key]) + width)
            if first < last:
                parts.append((key, first - int(starts[key]), (1 << (last - first)) - 1, first - low))
        passes.append(parts)
    return passes


def ranked(rows: DataFrame, keys: Sequence[str], rank: str = "rank", bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """`rows` with the column `rank`, 1 for the least key. `keys` are columns of whole numbers, the most significant first.

    No key may be null, and the difference of its least and greatest value must fit 64 bits (an error otherwise). Rows of equal keys
    get ranks beside each other, in whatever order. `rows` is read more than once: store what is costly or not repeatable.
    """
    least_first = list(reversed(keys))
    ends = rows.agg(F.count("*").alias("rows"), *(f(k).alias(f"{n}_{k}") for k in least_first for n, f in (("least", F.min), ("most", F.max)))).first()
    if not ends["rows"]:
        return rows.withColumn(rank, F.lit(1).cast("long"))
    least = [ends[f"least_{k}"] for k in least_first]
    widths = [int(ends[f"most_{k}"] - low).bit_length() for k, low in zip(least_first, least, strict=True)]
    current = rows.withColumn(POSITION, F.monotonically_increasing_id())
    for parts in _digits(widths, bits):
        digit = F.lit(0).cast("int")
        for key, shift, mask, place in parts:
            offset = F.col(least_first[key]).cast("long") - F.lit(least[key]).cast("long")
            digit = digit + F.shiftleft(F.shiftright(offset, shift).bitwiseAND(F.lit(mask).cast("long")), place).cast("int")
        current = stored(_passed(current, digit, block_bits))
    return current.select(*rows.columns, (F.col(POSITION) + 1).alias(rank) if any(widths) else F.lit(1).cast("long").alias(rank))


def _passed(rows: DataFrame, digit, block_bits: int) -> DataFrame:
    """`rows` with the positions that one stable counting sort by `digit` gives them."""
    spark = rows.sparkSession
    dealt = rows.withColumn(BLOCK, F.shiftright(POSITION, block_bits)).withColumn(DIGIT, digit)
    counts = dealt.groupBy(DIGIT, BLOCK).agg(F.count("*").alias("n"))
    bases, before = [], 0
    for row in counts.groupBy(DIGIT).agg(F.sum("n").alias("n")).orderBy(DIGIT).collect():  # 2^bits rows at most
        bases.append((row[DIGIT], before))
        before += row["n"]
    base = spark.createDataFrame(bases, f"{DIGIT} int, base long")
    earlier = Window.partitionBy(DIGIT).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(F.broadcast(base), DIGIT).select(
        F.col(BLOCK).alias("of"), F.col(DIGIT).alias("digit"), (F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("start")
    )
    kept = rows.columns

    def place(block: pa.Table, starts: pa.Table) -> pa.Table:
        digits = block.column(DIGIT).to_numpy()
        positions = block.column(POSITION).to_numpy()
        by_position = np.argsort(positions, kind="stable")
        order = by_position[np.argsort(digits[by_position].astype(np.uint16), kind="stable")]
        found, first, n = np.unique(digits[order], return_index=True, return_counts=True)
        start = dict(zip(starts.column("digit").to_pylist(), starts.column("start").to_pylist(), strict=True))
        target = np.empty(len(digits), np.int64)
        target[order] = np.repeat([start[d] for d in found.tolist()], n) + np.arange(len(digits)) - np.repeat(first, n)
        at = block.schema.get_field_index(POSITION)
        return block.set_column(at, POSITION, pa.array(target)).select(kept)

    return dealt.groupBy(BLOCK).cogroup(offsets.groupBy("of")).applyInArrow(place, rows.schema)
