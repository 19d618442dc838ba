"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

Best-fit decreasing is run over counts: all pieces of one length are placed together, into runs of sequences that have the same
room. The plan says for each length which ranks go to which sequences at which place, and has some entries per length, however many
documents there are. Documents then take their slots by joining on length and rank within the length.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

SIZE = 2048
#: Ranks are counted in groups of about so many pieces of one length.
RANKED_TOGETHER = 50_000
#: Plans of at most so many entries (about 40 bytes each) are broadcast; larger ones are joined by shuffling.
BROADCAST_ENTRIES = 200_000
#: A worker remembers the ids of the last REMEMBERED to 2 * REMEMBERED pieces, or of two stretches if they have more.
REMEMBERED = 200_000
#: Texts are tokenised together up to so many characters, new pieces up to so many pieces.
CHARACTERS_TOGETHER = 3_000_000
WORDS_TOGETHER = 200
LONGEST_REMEMBERED = 64
#: White space other than these may mean different things to the tokenizer and to Python.
_USUAL_SPACE = " \t\n\r"
_UNUSUAL = [chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in _USUAL_SPACE]


#: What a vocabulary file says of a tokenizer that lower-cases, drops white space and never merges across it.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


#: The pre-tokenizer's pieces, as the file has them.
_PIECES = regex.compile(WORDWISE["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
#: The same pieces of texts in which all letters are among ASCII and U+00C0 to U+024F, where only the signs for times and
#: divided by are none; much faster.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_IN_LATIN = re.compile(f"[\\x00-\\x7f{_LATIN}]*")
_LATIN_PIECES = re.compile(f"[a-z{_LATIN}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\sa-z0-9{_LATIN}]+")
#: These are lower-cased differently by Python and by the tokenizer.
_OTHER_CASE = ("\u03a3", "\u0130")


class WordTokenizer:
    """Ids of a tokenizer; one that never merges across words tokenises each distinct piece of many texts once.

    Whether texts may be taken apart is read from the file; other tokenizers, and texts with unusual white space, in another
    normal form or with an added token in any case, are tokenised whole. Ids are little-endian unsigned 32-bit integers.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.wordwise = all(told.get(part) == wanted for part, wanted in WORDWISE.items())
        self.added = [token["content"].lower() for token in told.get("added_tokens") or []]
        suffix = told["model"].get("end_of_word_suffix")
        #: Of each id, whether a piece ends with it; None where ids don't tell.
        self.ends: np.ndarray | None = None
        if self.wordwise and suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces. Many of letters alone go at once, and are parted where a piece ends."""
        found: dict[str, bytes] = {}
        if self.ends is not None:
            letters = [piece for piece in pieces if piece.isalpha()]
            groups = [letters[at : at + WORDS_TOGETHER] for at in range(0, len(letters), WORDS_TOGETHER)]
            for group, data in zip(groups, self._encode([" ".join(group) for group in groups]), strict=True):
                stops = (4 * np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 4).tolist()
                if len(stops) == len(group):
                    found.update((piece, data[i:j]) for piece, i, j in zip(group, [0, *stops], stops))
        others = [piece for piece in pieces if piece not in found]
        found.update(zip(others, self._encode(others), strict=True))
        return [found[piece] for piece in pieces]

    def _pieces_of(self, text: str) -> list[str] | None:
        """The text's pieces in lower case; None where it has to be looked at as a whole."""
        if not self.wordwise or any(c in text for c in _UNUSUAL) or not unicodedata.is_normalized("NFC", text):
            return None
        lowered = text.lower()
        if any(token in lowered for token in self.added) or any(c in text for c in _OTHER_CASE):
            return None
        return (_LATIN_PIECES if _IN_LATIN.fullmatch(lowered) else _PIECES).findall(lowered)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        apart = [self._pieces_of(text) for text in texts]
        counts = np.array([len(pieces or ()) for pieces in apart], np.int64)
        whole = [at for at, pieces in enumerate(apart) if pieces is None]
        found = pa.array(list(chain.from_iterable(pieces for pieces in apart if pieces)), pa.string()).dictionary_encode()
        ids_of = self._remembered(found.dictionary.to_pylist())
        lengths = np.array([len(ids) // 4 for ids in ids_of], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(ids_of), "<u4")
        order = found.indices.to_numpy()
        taken = lengths[order]
        ends = np.cumsum(taken)
        data = flat[np.repeat(starts[order] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = [data[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
        for at, ids in zip(whole, self._encode([texts[at] for at in whole]), strict=True):
            out[at] = ids
        return out

    def _remembered(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces: what is not among the last ones is tokenised."""
        known, older = self.known, self.older
        ids = [known.get(piece) or older.get(piece) for piece in pieces]
        missing = [at for at, found in enumerate(ids) if found is None]
        for at, found in zip(missing, self._encode_pieces([pieces[at] for at in missing]), strict=True):
            ids[at] = found
        if len(known) + len(pieces) > REMEMBERED:
            self.older, self.known = known, {}
        self.known.update((piece, found) for piece, found in zip(pieces, ids) if len(piece) <= LONGEST_REMEMBERED)
        return ids


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and vocabulary."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(
    rows: DataFrame,
    path: str,
    size: int = SIZE,
    end: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the ids of every text and `end`, cut where longer than `size`.

    Null texts are empty and give the piece of `end` alone. Without `with_ids` the column `ids` is left out.
    """
    columns = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        columns["ids"] = pa.binary()
        schema += ", ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for ids_of, texts in _together(batch):
                out: list[list] = [[] for _ in columns]
                for doc_id, ids in zip(ids_of, own.encode(texts), strict=True):
                    ids += last
                    for piece, start in enumerate(range(0, len(ids), 4 * size)):
                        own_ids = ids[start : start + 4 * size]
                        row = (doc_id, piece, start // 4, len(own_ids) // 4, zlib.crc32(own_ids), own_ids)
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, columns.values(), strict=True)], names=list(columns))

    chosen = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(cut, schema)


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of a batch, in stretches of about CHARACTERS_TOGETHER."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(doc_id.as_py())
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= CHARACTERS_TOGETHER:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: entries (length, first rank, last rank, first sequence, offset).

    The piece of that length with rank r between first and last goes to sequence `first sequence + r - first rank`.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    entries = []
    opened = 0

    def give(room: int, first: int, count: int) -> None:
        if room and count:
            if not runs[room]:
                insort(rooms, room)
            runs[room].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, there = runs[room].pop()
                if not runs[room]:
                    rooms.pop(at)
            else:
                room, first, there = size, opened, -(-left // (size // length))
                opened += there
            # A sequence that takes one piece has the least room that fits the next one, too: it is filled up.
            each = room // length
            full = min(there, left // each)
            rest = min(left - full * each, each - 1) if full < there else 0
            for turn in range(each if full else 0):
                entries.append((length, rank, rank + full - 1, first, size - room + turn * length))
                rank += full
            for turn in range(rest):
                entries.append((length, rank, rank, first + full, size - room + turn * length))
                rank += 1
            left -= full * each + rest
            used = full + (1 if rest else 0)
            give(room - each * length, first, full)
            if rest:
                give(room - rest * length, first + full, 1)
            give(room, first + used, there - used)
    return entries


def packed(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of `cut` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Lengths lie between 1 and `size`. Rows that are alike in all columns take slots of their own. No rows, no sequences.
    """
    spark = cut.sparkSession
    together = ["length", "salt"]
    salts = cut.count() // RANKED_TOGETHER + 1
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.lit(salts)))
    counted = salted.groupBy(*together).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(*together, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    histogram = {row["length"]: row["n"] for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    entries = plan(histogram, size)
    slots = spark.createDataFrame(entries or [], "length long, first long, last long, sequence long, offset long")
    within = Window.partitionBy(*together).orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("n", F.row_number().over(within))
        .join(offsets, together)
        .withColumn("r", F.col("ranks_before") + F.col("n") - 1)
        .drop("salt", "n", "ranks_before")
    )
    slots = slots.withColumnRenamed("length", "slot_length")
    if len(entries) <= BROADCAST_ENTRIES:
        slots = F.broadcast(slots)
    mine = (F.col("length") == F.col("slot_length")) & F.col("r").between(F.col("first"), F.col("last"))
    return ranked.join(slots, mine).select(
        *cut.columns, (F.col("sequence") + F.col("r") - F.col("first")).alias("sequence_id"), "offset"
    )


def packed_documents(
    rows: DataFrame, path: str, size: int = SIZE, end: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """All documents in as few sequences of `size` tokens as best-fit finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only documents longer than `size` are cut.
    Null texts are empty (one piece of the end token). Repeated rows and null ids are packed like others.
    """
    return packed(stored(pieces(rows, path, size, end, id_column, text_column, with_ids=False)), size)
