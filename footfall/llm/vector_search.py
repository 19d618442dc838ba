"""Exact top-k by inner product with vector-approximation files.

Every vector has a short approximation: per dimension the number of the cell its component lies in.
Blocks of queries scan blocks of approximations; the ends of the cells bound the inner product from
both sides, and what cannot reach the k-th best lower bound is dropped. What remains is read exactly in
the order of its upper bound: first the k best, then only those that could still beat the k-th.

Only approximations (a byte per dimension) are sent to every block of queries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import blocks, stored

#: A cell number fits a byte. Few cells give loose bounds: with 16, half of all vectors stay candidates in 64 dimensions.
CELLS = 64
#: Cell ends are quantiles of so many vectors at most; the outermost cells reach to the true ends.
MARKS_SAMPLE = 4096
SAMPLE_HASHES = 2**40
QUERY_BLOCK = 1024
DATA_BLOCK = 8192
#: Doubles beyond this are no 64-bit integers.
LARGEST = 2.0**63 - 1024
LARGEST_SCORE = 2**63 - 1


def packed(whole: np.ndarray) -> list[bytes]:
    """Every row of integers as bytes: 32 bits a component where the whole row fits, else 64."""
    short = (np.abs(whole) < 2**31).all(axis=1)
    if short.all():
        return [row.tobytes() for row in whole.astype("<i4")]
    return [row.astype("<i4" if fits else "<i8").tobytes() for row, fits in zip(whole, short, strict=True)]


def unpacked(rows: Iterable[bytes], dims: int) -> np.ndarray:
    """The integers (rows, dims) that `packed` made bytes of."""
    rows = list(rows)
    if all(len(row) == 4 * dims for row in rows):
        return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), dims).astype(np.int64)
    return np.stack([np.frombuffer(row, "<i4" if len(row) == 4 * dims else "<i8").astype(np.int64) for row in rows])


def integer_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """(row_id, vec_id, dims, v): floor(scale * x) of every component, as little-endian integers of 32 bits, or 64 where one needs them.

    Rows without id, and vectors that are null or hold a null or non-finite component, are left out. Scaled components
    beyond 64 bits are held at the ends of that range. `row_id` tells rows of one id apart; it lasts once the rows are stored.
    """

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            lengths = np.asarray(vectors.value_lengths().fill_null(-1))
            flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
            for dims in np.unique(lengths[lengths >= 0]):
                at = np.flatnonzero(lengths == dims)
                values = flat[starts[at][:, None] + np.arange(dims)]
                fine = np.isfinite(values).all(axis=1)
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(values[fine] * scale), -LARGEST, LARGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at[fine])),
                        pa.array(np.full(len(whole), dims, np.int32)),
                        pa.array(packed(whole), pa.binary()),
                    ],
                    names=["vec_id", "dims", "v"],
                )

    chosen = rows.select(F.col(id_column).cast("long").alias("i"), F.col(vector_column).alias("x"))
    integers = chosen.filter("i IS NOT NULL AND x IS NOT NULL").mapInArrow(scaled, "vec_id long, dims int, v binary")
    return integers.select(F.monotonically_increasing_id().alias("row_id"), "*")


def cell_marks(classes: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """For each number of dimensions the ends of the cells, as an array (dims, CELLS + 1).

    Inner ends are quantiles of a bounded sample, drawn by a hash below a limit that `counts`, the vectors by number of dimensions,
    sets; the outer ends are the least and greatest component of all vectors, so every vector lies in its cells.
    """

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least: dict[int, np.ndarray] = {}
        most: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, group in batch.groupby("dims"):
                values = unpacked(group["v"], dims)
                low, high = values.min(axis=0), values.max(axis=0)
                least[dims] = np.minimum(least.get(dims, low), low)
                most[dims] = np.maximum(most.get(dims, high), high)
        for dims in least:
            yield pd.DataFrame({"dims": dims, "d": np.arange(dims), "least": least[dims], "most": most[dims]})

    bounds = (
        classes.select("dims", "v")
        .mapInPandas(ends, "dims int, d int, least long, most long")
        .groupBy("dims", "d")
        .agg(F.min("least").alias("least"), F.max("most").alias("most"))
        .toPandas()
    )
    # Twice as many as are wanted pass the limit, so that few rows meet in the window's task, however many there are.
    drawn_to = {dims: min(SAMPLE_HASHES, -(-2 * MARKS_SAMPLE * SAMPLE_HASHES // n)) for dims, n in counts.items() if n}
    limit = F.coalesce(*(F.when(F.col("dims") == dims, F.lit(most)) for dims, most in drawn_to.items()), F.lit(SAMPLE_HASHES))
    sparse = classes.select("dims", "v", F.xxhash64("v").alias("h")).filter(F.pmod("h", F.lit(SAMPLE_HASHES)) < limit)
    order = Window.partitionBy("dims").orderBy("h", "v")
    sample = sparse.select("dims", "v", F.row_number().over(order).alias("n")).filter(f"n <= {MARKS_SAMPLE}").toPandas()
    marks = {0: np.zeros((0, CELLS + 1), np.int64)}
    for dims, group in bounds.groupby("dims"):
        group = group.sort_values("d")
        drawn = sample[sample["dims"] == dims]
        values = unpacked(drawn["v"] if len(drawn) else classes.filter(F.col("dims") == int(dims)).limit(1).toPandas()["v"], dims)
        inner = np.quantile(values, np.arange(1, CELLS) / CELLS, axis=0, method="lower").T
        ends_of = np.concatenate([group["least"].to_numpy()[:, None], inner, group["most"].to_numpy()[:, None]], axis=1)
        marks[int(dims)] = np.maximum.accumulate(ends_of, axis=1).astype(np.int64)
    return marks


def cells_of(values: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Cell numbers, a byte each. A value on a mark belongs to the cell above it, on several equal marks to the last."""
    cells = np.zeros(values.shape, np.uint8)
    for inner in range(1, CELLS):
        cells += values >= marks[:, inner]
    return cells


def cell_ends(cells: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer that each cell of each vector holds: a cell ends before the next one's mark."""
    least, most = marks[:, :-1], np.maximum(marks[:, :-1], marks[:, 1:] - 1)
    most[:, -1] = marks[:, -1]
    at = np.arange(len(marks))
    return least[at, cells], most[at, cells]


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the inner products. Float sums are exact below 2^53 and widened above."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    dims = queries.shape[1]
    largest = dims * float(max(1, np.abs(queries).max(initial=0))) * float(max(1, np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
    kind = np.float32 if largest < 2**24 else np.float64
    both = np.concatenate([plus, minus], axis=1).astype(kind)
    upper = both @ np.concatenate([high, low], axis=1).astype(kind).T
    lower = both @ np.concatenate([low, high], axis=1).astype(kind).T
    if largest >= 2**52:
        # Rounding of 2 * dims products and sums, of the factors and of what the bounds are compared with.
        spare = largest * (dims + 8) * 2.0**-50
        upper, lower = upper + spare, lower - spare
    return upper, lower


def scan(marks: dict[int, np.ndarray], k: int):
    """Function over one block of queries and one of approximations: the pairs that may be among the k best."""

    def scanned(_key, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "c": [], "upper": [], "lower": []}
        if len(queries) and len(data):
            dims = int(queries["dims"].iloc[0])
            held = np.frombuffer(b"".join(data["cells"]), np.uint8).reshape(len(data), dims)
            low, high = cell_ends(held, marks[dims])
            wanted = unpacked(queries["v"], dims)
            ids, names = data["class_id"].to_numpy(), queries["q"].to_numpy()
            for at in range(0, len(wanted), 128):
                upper, lower = bounds(wanted[at : at + 128], low, high)
                if len(ids) > k:
                    kth = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
                    row, column = np.nonzero(upper >= kth[:, None])
                else:
                    row, column = np.nonzero(np.ones_like(upper, bool))
                out["q"].append(names[at : at + 128][row])
                out["c"].append(ids[column])
                out["upper"].append(upper[row, column].astype(float))
                out["lower"].append(lower[row, column].astype(float))
        return pd.DataFrame({key: np.concatenate([np.empty(0, np.int64 if key in "qc" else float), *parts]) for key, parts in out.items()})

    return scanned


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products row by row, held at the ends of 64 bits: in 64 bits where none can leave them, else in Python's integers."""
    most = [float(max(1, np.abs(side.astype(float)).max(initial=0))) for side in (left, right)]
    if left.shape[1] * most[0] * most[1] < 2.0**62:
        return np.einsum("ij,ij->i", left, right)
    exact = (left.astype(object) * right.astype(object)).sum(axis=1)
    return np.array([min(max(int(score), -LARGEST_SCORE), LARGEST_SCORE) for score in exact], np.int64)


def exact_scores(pairs: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """(q, c, least, score) of pairs (q, c): the exact vectors are read for these alone."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(i).to_pylist() for i in (4, 5))
            scores = np.zeros(len(left), np.int64)
            lengths = batch.column(3).to_numpy()
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                scores[at] = products(*(unpacked([side[i] for i in at], int(dims)) for side in (left, right)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores)], names=["q", "c", "least", "score"])

    return (
        pairs.select("q", "c")
        .join(queries.select("q", F.col("v").alias("qv")), "q")
        .join(classes.select(F.col("class_id").alias("c"), "least", "dims", F.col("v").alias("cv")), "c")
        .select("q", "c", "least", "dims", "qv", "cv")
        .mapInArrow(multiplied, "q long, c long, least long, score long")
    )


def exact_top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The `k` rows of highest integer inner product for every query row: query_id, rank, vec_id, score.

    `is_query` is a condition on the column vec_id. All rows but the query's own are candidates; ties go to the smaller
    id; fewer than k candidates give fewer rows. Only vectors of the query's number of dimensions compare (empty ones
    score 0). Null and non-finite vectors and rows without id take no part. Rows that repeat an id are rows of their own, as
    candidates (also for each other) and as queries, each with ranks from 1. Components beyond 64 bits, and scores, are held at
    the ends of that range. An empty table gives no rows.

    Equal vectors are one class: its smallest k + 1 ids are all that any answer can need, so a vector shared by a third
    of the rows is scanned once.
    """
    spark = rows.sparkSession
    base = stored(integer_vectors(rows, id_column, vector_column, scale))
    classes = stored(base.groupBy("dims", "v").agg(F.min("row_id").alias("class_id"), F.min("vec_id").alias("least")))
    asked = base.filter(is_query)
    queries = (
        asked.select("dims", "v").distinct().join(classes, ["dims", "v"]).select("dims", "v", F.col("class_id").alias("q"))
    )
    counts = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    wanted = {r["dims"]: r["n"] for r in queries.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    n_data = {dims: blocks(n, DATA_BLOCK) for dims, n in counts.items()}
    n_query = {dims: blocks(n, QUERY_BLOCK) for dims, n in wanted.items()}
    if not n_query:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    marks = cell_marks(classes, counts)
    keep = k + 1

    def per_dims(numbers: dict[int, int]) -> Column:
        return F.coalesce(*(F.when(F.col("dims") == d, F.lit(n)) for d, n in numbers.items()), F.lit(1))

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.to_pandas()
            numbers = np.empty(len(table), object)
            for dims, group in table.groupby("dims"):
                numbers[group.index] = [row.tobytes() for row in cells_of(unpacked(group["v"], dims), marks[int(dims)])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("dims"), batch.column("class_id"), pa.array(numbers, pa.binary())], names=["dims", "class_id", "cells"]
            )

    searched = classes.filter(F.col("dims").isin(list(n_query)))
    cells = (
        searched.select("dims", "class_id", "v")
        .mapInArrow(approximated, "dims int, class_id long, cells binary")
        .withColumn("db", F.pmod(F.xxhash64("class_id"), per_dims(n_data)))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), per_dims(n_query) - 1)))
        .select("dims", F.col("qb").cast("int"), F.col("db").cast("int"), "class_id", "cells")
    )
    asking = (
        queries.withColumn("qb", F.pmod(F.xxhash64("q"), per_dims(n_query)))
        .withColumn("db", F.explode(F.sequence(F.lit(0), per_dims(n_data) - 1)))
        .select("dims", F.col("qb").cast("int"), F.col("db").cast("int"), "q", "v")
    )
    block = ["dims", "qb", "db"]
    near = (
        asking.groupBy(*block)
        .cogroup(cells.groupBy(*block))
        .applyInPandas(scan(marks, keep), "q long, c long, upper double, lower double")
    )
    by_query = Window.partitionBy("q")
    limit = F.max(F.when(F.col("by_lower") == keep, F.col("lower"))).over(by_query)
    near = (
        near.withColumn("by_lower", F.row_number().over(by_query.orderBy(F.desc("lower"), "c")))
        .withColumn("limit", limit)
        .filter("limit IS NULL OR upper >= limit")
        .select("q", "c", "upper", F.row_number().over(by_query.orderBy(F.desc("upper"), "c")).alias("turn"))
    )
    near = stored(near)
    first = stored(exact_scores(near.filter(F.col("turn") <= keep), queries, classes))
    reached = first.groupBy("q").agg(F.min("score").alias("kth"))
    rest = near.filter(F.col("turn") > keep).join(reached, "q").filter("upper >= kth")
    scored = first.unionByName(exact_scores(rest, queries, classes))
    best = F.row_number().over(by_query.orderBy(F.desc("score"), "least", "c"))
    scored = scored.withColumn("n", best).filter(F.col("n") <= keep).drop("n")

    # The first rows of every class; the first of those with one id is the query's own where both are alike.
    known = base.join(classes, ["dims", "v"]).select("row_id", "vec_id", F.col("class_id").alias("c"))
    within = Window.partitionBy("c").orderBy("vec_id")
    members = (
        known.select("c", "vec_id", F.row_number().over(within).alias("n"))
        .filter(F.col("n") <= keep)
        .select("c", "vec_id", F.row_number().over(Window.partitionBy("c", "vec_id").orderBy("n")).alias("turn"))
    )
    answers = (
        scored.join(members, "c")
        .withColumn("n", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id", "c", "turn")))
        .filter(F.col("n") <= keep)
    )
    named = asked.join(classes, ["dims", "v"]).select("row_id", F.col("vec_id").alias("query_id"), F.col("class_id").alias("q"))
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("c") == F.col("q")) & (F.col("turn") == 1)
    ranked = Window.partitionBy("row_id").orderBy("n")
    return (
        named.join(answers, "q")
        .filter(~own)
        .select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= k)
    )
