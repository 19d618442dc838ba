"""Resampling documents towards a target distribution by importance weights of hashed n-grams.

Runs of one and two words fall into a fixed number of buckets. Each bucket has a gain: how much more frequent it is in the target than
in the documents, as a logarithm. A document's weight is the mean gain of its features; with a random number for its id added, the
highest scores are a sample without replacement by weight. They are found by a radix sort (`radix_rank`).

Features are computed in arrays: checksums of all words of a batch are advanced together, byte by byte, and a run of words goes on
from the checksum of its first word.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.radix_rank import ranked

BUCKETS = 10_000
LONGEST_RUN = 2
LEAST_WORDS = 20
PERCENT = 25
#: Texts are taken together up to so many bytes; bounds a task's memory besides its longest text.
BYTES_TOGETHER = 4_000_000
#: Words of more bytes are summed one by one.
LONG_WORD = 48

def _steps() -> np.ndarray:
    """What each byte turns a checksum's last byte into: CRC-32 as in zlib."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


_STEPS = _steps()
_ALL = np.uint32(0xFFFFFFFF)
#: A-Z in lower case, other letters, digits and bytes beyond ASCII as they are, everything else a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def advanced(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums `state`, each gone on over its own bytes data[start:end]. They are kept without the last inversion."""
    state = state.copy()
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG_WORD):
        state[i] = zlib.crc32(data[starts[i] : ends[i]], int(state[i] ^ _ALL)) ^ 0xFFFFFFFF
    left = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
    step = 0
    while len(left):
        now = state[left]
        state[left] = _STEPS[(now ^ data[starts[left] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
        step += 1
        left = left[lengths[left] > step]
    return state


class Features:
    """The words and feature buckets of some texts, which lie one after the other in `data`, ending at `bounds[1:]`."""

    def __init__(self, data: bytes, bounds: np.ndarray, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> None:
        plain = np.frombuffer(data.translate(_PLAIN), np.uint8)
        inside = np.concatenate([[False], plain != 32, [False]])
        # A word also begins and ends where its text does.
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edges = bounds[(bounds > 0) & (bounds < len(plain))]
        begins[edges] |= inside[edges + 1]
        ends[edges - 1] |= inside[edges]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(starts, bounds)
        #: Words of each text.
        self.words = np.diff(first)
        owner = np.repeat(np.arange(len(self.words)), self.words)
        count = len(starts)
        state = advanced(np.full(count, _ALL), plain, starts, stops)
        found, owners = [state], [owner]
        blank = np.full(1, 32, np.uint8)
        for run in range(2, longest + 1):
            state = state[: count - run + 1] if count >= run else state[:0]
            later = np.arange(run - 1, run - 1 + len(state))
            state = advanced(state, blank, np.zeros(len(state), np.int64), np.ones(len(state), np.int64))
            state = advanced(state, plain, starts[later], stops[later])
            within = owner[: len(state)] == owner[later]
            found.append(state[within])
            owners.append(owner[: len(state)][within])
        #: Bucket of each feature, and the text it is in.
        self.buckets = ((np.concatenate(found) ^ _ALL) % np.uint32(buckets)).astype(np.int64)
        self.owners = np.concatenate(owners)

    @property
    def counts(self) -> np.ndarray:
        """Features of each text."""
        return np.bincount(self.owners, minlength=len(self.words))


def _together(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """The texts in stretches of about BYTES_TOGETHER: number of the first, bytes, and where each begins and the last ends."""
    lengths = np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BYTES_TOGETHER, side="right")) - 1)
        data = b"".join(texts.slice(at, upto - at).drop_null().cast(pa.binary()).to_pylist())
        yield at, data, bounds[at : upto + 1] - bounds[at]
        at = upto


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Features of all `texts` (a single column) in each bucket. A task sends one number a bucket, the driver gets their sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, bounds in _together(batch.column(0)):
                counts += np.bincount(Features(data, bounds, buckets, longest).buckets, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["bucket", "n"])

    found = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths by which the logarithm of a bucket's share is higher in the target, counts raised by one; rounded down."""
    size, sources, targets = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * float(sources + size)) / (float(s + 1) * float(targets + size))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(rows: DataFrame, gains: np.ndarray, id_column: str, text_column: str, longest: int = LONGEST_RUN) -> DataFrame:
    """Per row: doc_id, n_words, n_features and weight, the floored mean gain of its features (0 without any)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in _together(batch.column(1)):
                features = Features(data, bounds, len(gains), longest)
                counts = features.counts
                # Sums of whole numbers far below 2^53.
                sums = np.bincount(features.owners, weights=gains[features.buckets], minlength=len(counts)).astype(np.int64)
                ids = batch.column(0).slice(at, len(counts))
                columns = [ids, *(pa.array(c.astype(np.int64)) for c in (features.words, counts, sums // np.maximum(counts, 1)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    chosen = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resampled(
    rows: DataFrame,
    target: DataFrame,
    seed: str = "7:",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_features, weight, score and rank (1, 2, ... for the drawn ones by falling score, else null).

    A-Z are lower-cased; words are runs of a-z, 0-9 and characters beyond ASCII. Of the N documents with an id and at least
    `least_words` words, floor(percent * N / 100) of highest score are drawn, ties to the smaller doc_id, then to fewer features.
    `target` has texts in the same column. Null texts have no words. Rows without id have a weight but no score and are never
    drawn; rows repeating an id are documents of their own. An empty target or table makes no errors.
    """
    gains = bucket_gains(*(bucket_counts(side.select(F.col(text_column).cast("string")), buckets, longest) for side in (rows, target)))
    digits = F.substring(F.sha2(F.concat(F.lit(seed), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8)
    chance = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(chance)))
    scored = stored(weighted(rows, gains, id_column, text_column, longest).withColumn("score", F.col("weight") + noise))
    eligible = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    drawn = scored.filter(eligible).count() * percent // 100
    ordered = ranked(scored.filter(eligible).withColumn("falling", -F.col("score")), ["falling", "doc_id", "n_features"])
    ordered = ordered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ordered.select(*columns).unionByName(others.select(*columns))
