"""Exact n-gram Jaccard join by size-banded tiles, hashed bitmap signatures and sorted-array intersection.

* Every text becomes the sorted array of its distinct shingle hashes. Equal sets are one class and looked at once.
* Two sets that are similar enough share one of their rarest shingles. A tile holds the sets with one such shingle, ordered by
  size; only sizes within the band that the threshold allows meet, and only where enough may follow the shared one.
* A bitmap has for each bit the parity of the hashes on it. The bits in which two bitmaps differ are at most as many as the
  shingles in which the sets differ: that bounds the overlap from above.
* What remains is intersected exactly.

Tiles of a few sets name all their pairs. Larger ones, dealt into blocks, name first a spanning forest of the pairs that differ in
the fewest bits, which ties most of a large group together with fewer pairs than it has sets. Then tiles that are not in one
component compare what is in different ones, block by block, and name every pair that the bitmaps allow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored
from footfall.llm.components import components

WORDS = 5
#: Jaccard similarity of at least PERCENT / 100.
PERCENT = 80
#: Shingles are counted in so many buckets, a table of fixed size.
BUCKET_BITS = 20
SLICES = 64
#: Tiles of at most so many sets name all their pairs; larger ones compare bitmaps first.
SMALL_TILE = 6
#: Larger tiles are dealt into blocks of about so many sets.
SIDE = 1024
#: Bitmaps that go along into tiles are folded to so many bits at most; the whole ones are compared afterwards.
TILE_BITS = 1024
#: Up to so many candidates (8 bytes each) are broadcast to the texts; beyond, texts and candidates are shuffled.
BROADCAST_CANDIDATES = 500_000

_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `words` words; of fewer words, one hash of them all; of none, nothing.

    A-Z are lower-cased; words are what blanks and the controls 9 to 13 leave.
    """
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    count = len(parts) - words + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(words):
        mixed *= np.uint64(0x100000001B3)
        mixed += hashes[i : i + count] * _FACTORS[i % len(_FACTORS)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """So many of its rarest shingles must hold one that any similar set has as well."""
    return size - -(-size * percent // 100) + 1


def least_overlap(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The overlap that a sum of two sizes needs: percent * union <= 100 * overlap."""
    return -(-percent * sizes // (100 + percent))


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes on each bit; the width grows with the set, a power of two."""
    width = 64
    while 2 * width < 3 * len(hashes):
        width *= 2
    counts = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def differing_bits(left: bytes, right: bytes) -> int:
    """Bits in which two bitmaps differ, the wider one folded to the width of the other."""
    if len(left) < len(right):
        left, right = right, left
    a, b = int.from_bytes(left), int.from_bytes(right)
    width = 8 * len(left)
    while width > 8 * len(right):
        width //= 2
        a = (a >> width) ^ (a & (1 << width) - 1)
    return (a ^ b).bit_count()


def _texts(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def bucket_levels(texts: DataFrame, words: int) -> np.ndarray:
    """How common the shingles of each bucket are, over all texts: the binary logarithm of the bucket's count."""
    size = 1 << BUCKET_BITS
    each = size // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros(size, np.int64), False
        for batch in batches:
            for text in batch.column(0):
                hashes = shingle_hashes(text.as_py(), words)
                if len(hashes):
                    some = True
                    np.add.at(counts, (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        if some:
            task = TaskContext.get().partitionId()
            parts = [zstandard.compress(counts[i * each : (i + 1) * each].tobytes(), 1) for i in range(SLICES)]
            columns = [pa.array(range(SLICES), pa.int32()), pa.array([task >> 8] * SLICES, pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "task", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(each, np.int64)
        for part in rows["counts"]:
            total += np.frombuffer(zstandard.decompress(part), np.int64)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "task": 0, "counts": [zstandard.compress(total.tobytes(), 1)]})

    kind = "slice int, task int, counts binary"
    counted = texts.select("text").mapInArrow(count, kind)
    # 256 tasks at a time, then what remains of each slice: fixed-size arrays throughout.
    added = counted.groupBy("slice", "task").applyInPandas(add, kind).groupBy("slice").applyInPandas(add, kind)
    totals = np.zeros(size, np.int64)
    for row in added.collect():
        totals[row["slice"] * each : (row["slice"] + 1) * each] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.int64)
    return np.log2(np.maximum(totals, 1)).astype(np.uint8)


def described(texts: DataFrame, levels: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per text: doc_id, n (set size), digest of the set, its rarest shingles in order, its bitmap."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)  # a byte for every bucket: 1 MB

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, digests, prefixes, bitmaps = [], [], [], []
                for text in part.column(1):
                    hashes = shingle_hashes(text.as_py(), words)
                    sizes.append(len(hashes))
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    if len(hashes):
                        keys = level[hashes >> np.uint64(64 - BUCKET_BITS)].astype(np.uint64) << np.uint64(57) | hashes >> np.uint64(7)
                        wanted = prefix_length(len(hashes), percent)
                        keys = np.sort(np.partition(keys, wanted - 1)[:wanted])
                        prefixes.append(keys.tobytes())
                        bitmaps.append(bitmap(hashes))
                    else:
                        prefixes.append(b"")
                        bitmaps.append(b"")
                columns = [part.column(0), pa.array(sizes, pa.int64()), *(pa.array(c, pa.binary()) for c in (digests, prefixes, bitmaps))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "digest", "prefix", "bits"])

    return texts.mapInArrow(describe, "doc_id long, n long, digest binary, prefix binary, bits binary")


def _tile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, n, place) for each of a set's rarest shingles; place is its rank among them."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            prefixes = [np.frombuffer(p.as_py(), np.int64) for p in part.column(2)]
            lengths = np.array([len(p) for p in prefixes])
            if not lengths.sum():
                continue
            columns = [
                np.concatenate(prefixes),
                np.repeat(part.column(0).to_numpy(), lengths),
                np.repeat(part.column(1).to_numpy(), lengths).astype(np.int32),
                np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "n", "place"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[list[np.ndarray]]:
    """Columns of whole tiles or blocks: batches cut where one of the first `keys` columns changes."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        cut = list(_spans(*held[:keys]))[-1][0]
        if cut:
            yield [c[:cut] for c in held]
            held = [c[cut:] for c in held]
    if held is not None:
        yield held


def _spans(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """First row and end of each run of equal keys."""
    change = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(keys[0])]])
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _fits(n_a: np.ndarray, at_a: np.ndarray, n_b: np.ndarray, at_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes are in one band and the shingles from the shared one on are enough."""
    n_a, n_b = n_a.astype(np.int64), n_b.astype(np.int64)
    band = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return band & (np.minimum(n_a - at_a, n_b - at_b) >= least_overlap(n_a + n_b, percent))


class _Tile:
    """Sets that share a shingle, ordered by size, with their bitmaps as words of 64 bits."""

    def __init__(self, node: np.ndarray, n: np.ndarray, place: np.ndarray, bits: np.ndarray, percent: int):
        self.node, self.n, self.place, self.percent = node, n.astype(np.int64), place.astype(np.int64), percent
        self.width = np.fromiter(map(len, bits), np.int64, len(bits))
        # Wider bitmaps belong to larger sets, so each width is a run of rows. `folded` has for a width all rows that are as wide or wider.
        self.starts = {int(w): int(np.searchsorted(self.width, w)) for w in np.unique(self.width)}
        self.folded: dict[int, np.ndarray] = {}
        wider = None
        for w, start in reversed(self.starts.items()):
            stop = int(np.searchsorted(self.width, w, side="right"))
            own = np.frombuffer(b"".join(bits[start:stop]), np.uint64).reshape(stop - start, w // 8)
            if wider is not None:
                while wider.shape[1] > w // 8:
                    half = wider.shape[1] // 2
                    wider = wider[:, :half] ^ wider[:, half:]
                own = np.concatenate([own, wider])
            self.folded[w] = wider = own

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each set may be similar enough to set i, by size, place and bits; and the share of bits that differ."""
        differ = np.empty(len(self.n), np.int64)
        widths = [w for w in self.starts if w <= self.width[i]]
        for w, following in zip(widths, [*widths[1:], None], strict=True):
            start = self.starts[w]
            stop = len(self.n) if following is None else self.starts[following]
            rows = self.folded[w]
            differ[start:stop] = np.bitwise_count(rows[: stop - start] ^ rows[i - start]).sum(axis=1, dtype=np.int64)
        sizes = self.n + self.n[i]
        fine = _fits(self.n[i], self.place[i], self.n, self.place, self.percent)
        fine &= (sizes - differ) // 2 >= least_overlap(sizes, self.percent)
        return fine, differ / sizes

    def forest(self) -> list[tuple[int, int]]:
        """Pairs that tie together what may be similar: a spanning forest of the least differing ones, fewer than the sets."""
        outside = np.ones(len(self.n), bool)
        best, via = np.full(len(self.n), np.inf), np.zeros(len(self.n), np.int64)
        found = []
        i = 0
        for _ in range(len(self.n) - 1):
            outside[i] = False
            best[i] = np.inf
            fine, differ = self.near(i)
            closer = np.flatnonzero(outside & fine & (differ < best))
            best[closer], via[closer] = differ[closer], i
            i = int(np.argmin(best))
            if np.isinf(best[i]):
                i = int(np.argmax(outside))
            else:
                found.append((self.node[via[i]], self.node[i]))
        return found

    def across(self, part: np.ndarray, side: np.ndarray | None) -> Iterator[np.ndarray]:
        """All pairs that may be similar and are in different components; given sides, only pairs from both sides."""
        names, sizes = np.unique(part, return_counts=True)
        largest = part == names[np.argmax(sizes)]
        for i in np.flatnonzero(~largest):
            wanted = (part != part[i]) & (largest | (np.arange(len(part)) > i))
            if side is not None:
                wanted &= side != side[i]
            fine, _ = self.near(i)
            j = np.flatnonzero(fine & wanted)
            if len(j):
                yield np.stack([np.full(len(j), self.node[i]), self.node[j]], axis=1)


def _small_tiles(percent: int):
    """All pairs (a, b) of tiles of SMALL_TILE sets at most, by size and place."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, node, n, place in _runs(batches):
            found = []
            for step in range(1, min(SMALL_TILE, len(token))):
                left = np.flatnonzero(token[:-step] == token[step:])
                right = left + step
                fine = _fits(n[left], place[left], n[right], place[right], percent)
                found.append(np.stack([node[left[fine]], node[right[fine]]], axis=1))
            if found:
                yield _pairs(found)

    return paired


def _tied(percent: int):
    """Pairs (a, b) of a spanning forest of each block of the larger tiles."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, seed, block, node, n, place, bits in _runs(batches, 3):
            found = []
            for first, stop in _spans(token, seed, block):
                pairs = _Tile(node[first:stop], n[first:stop], place[first:stop], bits[first:stop], percent).forest()
                found.append(np.array(pairs, np.int64).reshape(-1, 2))
            yield _pairs(found)

    return paired


def _open(percent: int):
    """All pairs (a, b) of the larger tiles that are not in one component; a tile comes as pairs of blocks (one, two)."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, one, two, block, node, n, place, bits, part in _runs(batches, 3):
            found: list[np.ndarray] = []
            held = 0
            for first, stop in _spans(token, one, two):
                own = slice(first, stop)
                if (part[own] == part[first]).all():
                    continue
                side = None if one[first] == two[first] else block[own]
                for pairs in _Tile(node[own], n[own], place[own], bits[own], percent).across(part[own], side):
                    found.append(pairs)
                    held += len(pairs)
                    if held > 200_000:
                        yield _pairs(found)
                        found, held = [], 0
            if held:
                yield _pairs(found)

    return paired


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of TILE_BITS at most, to go along into every tile."""
    for batch in batches:
        folded = []
        for bits in batch.column(1).to_pylist():
            while 8 * len(bits) > TILE_BITS:
                words = np.frombuffer(bits, np.uint64)
                bits = (words[: len(words) // 2] ^ words[len(words) // 2 :]).tobytes()
            folded.append(bits)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(folded, pa.binary())], names=["node", "bits"])


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _bounded(percent: int):
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = np.fromiter(
                map(differing_bits, batch.column(4).to_pylist(), batch.column(5).to_pylist()), np.int64, batch.num_rows
            )
            fine = pa.array((n - differ) // 2 >= least_overlap(n, percent))
            yield batch.select([0, 1]).filter(fine)

    return bound


def _exact(percent: int):
    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
                overlap = len(np.intersect1d(a, b, assume_unique=True))
                fine.append(overlap >= least_overlap(len(a) + len(b), percent))
            yield batch.select([0, 1]).filter(pa.array(fine, pa.bool_()))

    return intersect


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough: bounded by bitmaps, then intersected exactly."""
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ba", "bb")
    near = stored(near.mapInArrow(_bounded(percent), "a long, b long"))
    wanted = stored(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    if wanted.count() <= BROADCAST_CANDIDATES:
        wanted = F.broadcast(wanted)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_hashes(text.as_py(), words).tobytes() for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])

    sets = stored(texts.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(hashed, "node long, hashes binary"))
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = near.join(a, "a").join(b, "b").select("a", "b", "ha", "hb")
    return stored(both.mapInArrow(_exact(percent), "a long, b long"))


def jaccard_components(
    rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach, its own included).

    Texts link when the Jaccard similarity of their sets of word shingles is at least percent / 100. Texts without words, null
    ones too, have no shingles and link with nothing. Rows with a null id take no part; their component is null. Repeated rows
    come out as they came in; texts under one id each stand for themselves. An empty table gives no rows.
    Sets are compared by 64-bit hashes of their shingles.
    """
    texts = _texts(rows, id_column, text_column)
    levels = bucket_levels(texts, words)
    features = stored(described(texts, levels, words, percent))
    # What a class has besides its members is the same for all of them.
    classes = (
        features.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    )
    classes = stored(classes)
    rows = classes.select("node", "n", "prefix").mapInArrow(_tile_rows, "token long, node long, n int, place int")
    repeated = rows.groupBy("token").agg(F.count("*").alias("sets")).filter("sets > 1")
    tiles = stored(rows.join(repeated, "token"))
    pair = "a long, b long"
    small = tiles.filter(F.col("sets") <= SMALL_TILE).select("token", "node", "n", "place")
    small = small.repartition("token").sortWithinPartitions("token", "n", "node").mapInArrow(_small_tiles(percent), pair)
    # Larger tiles are dealt into blocks, twice where there are several, so that what one deal parts the other may tie.
    bits = classes.select("node", "bits").mapInArrow(_folded, "node long, bits binary")
    large = tiles.filter(F.col("sets") > SMALL_TILE).withColumn("blocks", F.ceil(F.col("sets") / SIDE).cast("int"))
    large = stored(large.join(bits, "node"))
    seeds = F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    tied = (
        large.withColumn("seed", F.explode(seeds))
        .withColumn("block", F.pmod(F.xxhash64("node", "seed"), F.col("blocks")).cast("int"))
        .select("token", "seed", "block", "node", "n", "place", "bits")
        .repartition("token", "seed", "block")
        .sortWithinPartitions("token", "seed", "block", "n", "node")
        .mapInArrow(_tied(percent), pair)
    )
    links = _links(stored(small.unionByName(tied).distinct()), classes, texts, words, percent)
    whole = components(links)
    parts = large.join(whole.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    parts = stored(parts)
    left_open = parts.groupBy("token").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least <> most")
    more = (
        parts.join(left_open.select("token"), "token", "left_semi")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(0)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "n", "place", "bits", "part")
        .repartition("token", "one", "two")
        .sortWithinPartitions("token", "one", "two", "n", "node")
        .mapInArrow(_open(percent), pair)
    )
    more = stored(more.distinct())
    if not more.isEmpty():
        whole = components(links.unionByName(_links(more, classes, texts, words, percent)))
    reached = classes.select("digest", "node").join(whole, "node", "left")
    reached = reached.select("digest", F.coalesce("component", "node").alias("reached"))
    plain = features.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    return plain.join(reached, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("reached", "doc_id")).alias("component_id"),
    )
