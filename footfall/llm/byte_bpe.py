"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of a pre-token form a linked list. Every pair of neighbours that the vocabulary can merge waits in the bucket of
its rank; a bitmap of two levels tells which buckets hold anything, and the first set bit is the next rank. A merge
makes waiting pairs stale; they are skipped when their turn comes. The work is about linear in the pre-token's length, however
long it is.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word of the bitmap has so many bits; its ranks share one bit of the upper level.
SHIFT = 8
WORD = 1 << SHIFT
#: A worker remembers the last REMEMBERED to 2 * REMEMBERED pre-tokens it met. Long ones are not kept.
REMEMBERED = 450_000
LONGEST_REMEMBERED = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: a base64 token and its rank on every line."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The token ids of one pre-token.

    The queue has three parts: `buckets` with the positions that wait at a rank, leftmost first; `words`, in which bit
    `rank % WORD` of word `rank // WORD` is set while that bucket holds any; and `upper`, with a bit for every word that is not 0.
    It stands in the loop itself, as calls would cost more than the work they do.
    """
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    size = len(piece)
    # Token i spans piece[i:end[i]]; before[i] is where its left neighbour starts; end[i] = 0 once it is merged away.
    end = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    upper = 0
    waiting = [(rank_of(piece[at : at + 2]), at) for at in range(size - 1)]
    while True:
        for rank, at in waiting:
            if rank is None:
                continue
            bucket = buckets.get(rank)
            if bucket:
                heappush(bucket, at)
                continue
            buckets[rank] = [at]
            word = rank >> SHIFT
            words[word] = words.get(word, 0) | 1 << (rank & WORD - 1)
            upper |= 1 << word
        if not upper:
            break
        word = (upper & -upper).bit_length() - 1
        bits = words[word]
        rank = (word << SHIFT) + (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        at = heappop(bucket)
        if not bucket:
            bits &= bits - 1
            words[word] = bits
            if not bits:
                upper &= upper - 1
        waiting = ()
        middle = end[at]
        if not middle or middle >= size:
            continue
        stop = end[middle]
        if rank_of(piece[at:stop]) != rank:
            continue
        end[at], end[middle] = stop, 0
        left = before[at]
        if stop < size:
            before[stop] = at
            if left >= 0:
                waiting = ((rank_of(piece[at : end[stop]]), at), (rank_of(piece[left:stop]), left))
            else:
                waiting = ((rank_of(piece[at : end[stop]]), at),)
        elif left >= 0:
            waiting = ((rank_of(piece[left:stop]), left),)
    ids = []
    at = 0
    while at < size:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Encoder:
    """Encodes whole texts. Ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.blanks = regex.compile(r"\s\s").search
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.known.get(piece) or self.older.get(piece)
        if ids is None:
            ids = array("I", merge(piece.encode("utf-8", "replace"), self.ranks)).tobytes()
        return self._remember(piece, ids)

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of `text`.

        Where no two white spaces meet, a single blank always begins a match of the pattern, so that the text may be looked up
        blank by blank; other texts are matched as one.
        """
        if self.blanks(text):
            return b"".join([self._piece(piece) for piece in self.find(text)])
        first, *others = text.split(" ")
        known = self.known.get
        out = [self._stretch(first)] if first else []
        for word in others:
            stretch = " " + word
            out.append(known(stretch) or self._stretch(stretch))
        return b"".join(out)

    def _stretch(self, stretch: str) -> bytes:
        ids = self.older.get(stretch)
        if ids is None:
            pieces = self.find(stretch)
            if len(pieces) == 1:
                return self._piece(stretch)
            ids = b"".join([self._piece(piece) for piece in pieces])
        return self._remember(stretch, ids)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def encoded(
    rows: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row of `rows`: doc_id and ids (binary, little-endian unsigned 32-bit). Null texts count as empty: no ids.

    `path` names a rank file that every worker can open. Repeated rows and null ids come out as they came in.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = pa.array([own.encode(text.as_py() or "") for text in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return _chosen(rows, id_column, text_column).mapInArrow(encode, "doc_id long, ids binary")


def decoded(rows: DataFrame, path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Per row: doc_id and bytes, what the ids stand for. Null ids give no bytes; ids outside the vocabulary fail."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            out = pa.array([own.decode(ids.as_py() or b"") for ids in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["doc_id", "bytes"])

    chosen = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).alias("ids"))
    return chosen.mapInArrow(decode, "doc_id long, bytes binary")


def round_trip_digests(
    rows: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256, the hex digests of the ids and of what they decode to.

    Ids and texts stay in the task that has them; only digests leave it. Null texts count as empty.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            counts, ids_digests, decoded_digests = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                decoded_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(decoded_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _chosen(rows, id_column, text_column).mapInArrow(digest, schema)


def _chosen(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
