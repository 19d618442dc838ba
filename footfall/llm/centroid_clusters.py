"""Centroid clustering of integer vectors: Lloyd's rounds, the nearest centroid found in a vantage-point tree.

The centroids are few and go to every task. Each round builds a vantage-point tree over them: a node holds one centroid and parts
the others by their distance from it. Every vector has a queue of its own over the nodes, ordered by the least distance that a
node can still hold, and opens the nearest node first. It stops when the next node lies farther than the best centroid found; a
node at the same distance is still opened, since it may hold a centroid of smaller number. Distances are whole numbers, computed
exactly; the bounds are floating point and widened by more than they can be wrong.

Vectors are never moved: a task adds up its own vectors by cluster, and only these sums are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
#: Nodes of the tree hold so many centroids at most without parting them further.
LEAF = 4
#: Vectors searched side by side; bounds a task's memory.
TOGETHER = 8192
LONGEST = 2**63 - 1
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(rows: DataFrame, dims: int, scale: float, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component x, as 64-bit integers.

    Vectors of another length, that are null, or that hold a null or non-finite component take no part; neither do those with a
    component that has no 64-bit integer. Everything else stays: rows without id, repeated rows.
    """

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.columns
            lengths = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
            flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            at = np.flatnonzero(lengths == dims)
            values = flat[starts[at][:, None] + np.arange(dims)]
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values * scale)
            fits = (np.abs(values) < 2.0**63).all(axis=1)  # also false for what is no number
            whole = values[fits].astype(np.int64)
            offsets = np.arange(len(whole) + 1, dtype=np.int32) * dims
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.reshape(-1)))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at[fits])), found], names=["vec_id", "v"])

    chosen = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
    return chosen.filter(F.size("v") == dims).mapInArrow(scaled, "vec_id long, v array<long>")


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dims)


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector from each centroid, exact: 64-bit integers, or Python's where those may not do."""
    most = max(abs(int(end)) for side in (vectors, centroids) for end in ((side.min(), side.max()) if side.size else (0,)))
    largest = vectors.shape[1] * (2 * most) ** 2
    if largest < 2**52:
        # Whole numbers below 2^53 are exact in floating point, in whatever order they are added up.
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    kind = np.int64 if largest < 2**63 else object
    x, c = vectors.astype(kind), centroids.astype(kind)
    return np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1)


@dataclass
class Node:
    """The centroids it holds, by number, and for each child its node and the least and greatest distance from the first of them."""

    held: np.ndarray
    children: list[tuple[int, float, float]]


class VantageTree:
    """Nearest of some centroids; of equally near ones that of smallest number."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.nodes: list[Node] = []
        self._grow(np.arange(len(centroids)))

    def _grow(self, numbers: np.ndarray) -> int:
        at = len(self.nodes)
        if len(numbers) <= LEAF:
            self.nodes.append(Node(np.sort(numbers), []))
            return at
        # The centroid farthest from the first parts the others best.
        vantage = numbers[int(squares(self.centroids[numbers[:1]], self.centroids[numbers])[0].argmax())]
        rest = numbers[numbers != vantage]
        away = squares(self.centroids[[vantage]], self.centroids[rest])[0]
        node = Node(np.array([vantage]), [])
        self.nodes.append(node)
        middle = np.sort(away)[(len(away) - 1) // 2]
        for side in (away <= middle, away > middle):
            if side.any():
                ends = np.sqrt(np.array([away[side].min(), away[side].max()], np.float64))
                node.children.append((self._grow(rest[side]), float(ends[0]), float(ends[1])))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's centroid."""
        labels, best = np.zeros(len(vectors), np.int32), np.zeros(len(vectors), object)
        for at in range(0, len(vectors), TOGETHER):
            part = slice(at, at + TOGETHER)
            labels[part], best[part] = self._search(vectors[part])
        return labels, best

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(vectors)
        label = np.full(count, -1, np.int32)
        best = np.zeros(count, object if squares(vectors[:1], self.centroids).dtype == object else np.int64)
        limit = np.full(count, np.inf)
        # A queue per vector: for each node the least distance of what it holds; infinite where it isn't queued.
        queued = np.full((count, len(self.nodes)), np.inf)
        queued[:, 0] = 0.0
        active = np.arange(count)
        while len(active):
            first = queued[active].argmin(axis=1)
            bound = queued[active, first]
            open_still = np.isfinite(bound) & (bound <= limit[active])
            active, first, bound = active[open_still], first[open_still], bound[open_still]
            queued[active, first] = np.inf
            for number in np.unique(first):
                mine = first == number
                rows, node = active[mine], self.nodes[number]
                away = squares(vectors[rows], self.centroids[node.held])
                if away.dtype != best.dtype and away.dtype == object:
                    best = best.astype(object)
                turn = away.argmin(axis=1)
                least, found = away[np.arange(len(rows)), turn], node.held[turn]
                better = (label[rows] < 0) | (least < best[rows]) | ((least == best[rows]) & (found < label[rows]))
                changed = rows[better]
                label[changed], best[changed] = found[better], least[better]
                limit[changed] = np.sqrt(least[better].astype(np.float64))
                for child, low, high in node.children:
                    far = np.sqrt(away[:, 0].astype(np.float64))
                    # Roots and differences are off by a few units of the last place; this is far more.
                    slack = (far + high) * 2.0**-40
                    queued[rows, child] = np.maximum(bound[mine], np.maximum(far - high, low - far) - slack)
        return label, best


def _first_centroids(base: DataFrame, count: int, prefix: str) -> np.ndarray | None:
    """The vectors of smallest hash of `prefix` and id; rows without id last, equal ids by vector."""
    named = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = base.select(named.alias("hash"), "v").orderBy(F.col("hash").asc_nulls_last(), "v").limit(count).collect()
    return np.array([row["v"] for row in chosen], np.int64) if chosen else None


def _summed(base: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """For each cluster that has vectors, how many and the sums of their components."""
    dims = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = VantageTree(centroids)
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), object)
        for batch in batches:
            vectors = matrix(batch.column(0), dims)
            if not len(vectors):
                continue
            labels, _ = tree.nearest(vectors)
            order = np.argsort(labels, kind="stable")
            found, starts = np.unique(labels[order], return_index=True)
            wide = len(vectors) * max(abs(int(vectors.min())), abs(int(vectors.max()))) >= 2**62
            sums[found] += np.add.reduceat(vectors[order].astype(object if wide else np.int64), starts, axis=0).astype(object)
            counts += np.bincount(labels, minlength=len(centroids))
        some = np.flatnonzero(counts)
        totals = pa.array([[Decimal(x) for x in sums[i]] for i in some], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), totals], names=["cluster", "n", "sums"])

    parts = base.select("v").mapInArrow(add, "cluster int, n long, sums array<decimal(38,0)>")
    totals = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("total"))
    found: dict[int, tuple[int, list[int]]] = {}
    for row in totals.collect():  # clusters * dimensions
        found.setdefault(row["cluster"], (row["n"], [0] * dims))[1][row["pos"]] = int(row["total"])
    return found


def _assigned(base: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = VantageTree(centroids)
        for batch in batches:
            labels, away = tree.nearest(matrix(batch.column(1), dims))
            distances = pa.array([int(x) if x <= LONGEST else None for x in away], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels), distances], names=["vec_id", "cluster", "distance"])

    return base.mapInArrow(assign, "vec_id long, cluster int, distance long")


def centroid_clusters(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: float = 256.0,
    dims: int = DIMENSIONS,
    prefix: str = "2:",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components are floor(scale * x). Centroids start as the `clusters` vectors of smallest hash of `prefix` and id (all vectors, if
    fewer). A round gives every vector its nearest centroid, ties to the smaller number, then moves each centroid to the floored
    mean of its vectors; one without vectors stays. After the rounds, vectors are assigned once more.

    Vectors that are null, of another length or hold a null or non-finite component take no part. Rows without id belong to a
    cluster like others and become centroids last. Repeated rows count as often as they stand there. An empty table gives no rows.
    Squared distances and their sums beyond 64 bits are null; which centroid is nearest is exact even then.
    """
    spark = rows.sparkSession
    base = stored(integer_vectors(rows, dims, scale, id_column, vector_column))
    centroids = _first_centroids(base, clusters, prefix)
    if centroids is None:
        return spark.createDataFrame([], SCHEMA)
    for _ in range(rounds):
        for number, (count, sums) in _summed(base, centroids).items():
            centroids[number] = [total // count for total in sums]
    found = stored(_assigned(base, centroids))
    return found.join(F.broadcast(_inertia(found, centroids)), "cluster").select(*(name.split()[0] for name in SCHEMA.split(", ")))


def _inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """A row for each cluster: the distances summed up over it and over all, and the digest of its centroid."""
    spark = found.sparkSession
    wide = F.col("distance").cast("decimal(38,0)")
    sums = found.groupBy("cluster").agg(F.sum(wide).alias("total"), F.bool_or(F.col("distance").isNull()).alias("unknown")).collect()
    totals = {row["cluster"]: None if row["unknown"] else int(row["total"]) for row in sums}  # as many as there are centroids
    whole = None if None in totals.values() else sum(totals.values())
    held = [(number, _long(total), _long(whole), centroid_digest(centroids[number])) for number, total in totals.items()]
    return spark.createDataFrame(held, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def _long(value: int | None) -> int | None:
    return value if value is not None and value <= LONGEST else None


def centroid_digest(components: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in components).encode()).hexdigest()
