"""Standardising features and grouping rows by k-means, all restarts in one pass over the rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300
# Stop once the squared moves of all centres, on standardised features, add up to this.
TOLERANCE = 1e-4


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population deviation per column, nulls read as 0; a constant column becomes 0."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = df.agg(F.struct(
        *[F.avg(x).alias(f"m_{c}") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"s_{c}") for c, x in filled.items()],
    ).alias("s"))
    scaled = {
        c + suffix: F.coalesce(F.try_divide(x - F.col(f"_s.m_{c}"), F.col(f"_s.s_{c}")), F.lit(0.0))
        for c, x in filled.items()
    }
    return df.withColumn("_s", stats.scalar()).withColumns(scaled).drop("_s")


@dataclass(frozen=True)
class Centres:
    """The best of several fits: k x d centres, the squared distances to them in all, and the passes that were made."""

    points: np.ndarray
    cost: float
    passes: int

    def nearest(self, vector: Column) -> Column:
        """The centre nearest to a vector (array of double), the lowest of equals; null for null."""
        def gap(centre: np.ndarray) -> Column:
            ends = F.array(*[F.lit(float(x)) for x in centre])
            return F.aggregate(F.zip_with(vector, ends, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda a, b: a + b)

        gaps = [F.struct(gap(c).alias("gap"), F.lit(j).alias("j")) for j, c in enumerate(self.points)]
        return F.when(vector.isNotNull(), F.array_min(F.array(*gaps))["j"])


#: Numbers of the vectors that one task of a pass takes, about.
_VALUES_A_TASK = 1 << 18


# Functions for tasks are made by functions and use only their own names and modules: a task need not have this package.


def _packing() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrays of double as one block of bytes a batch, with their number and length."""
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if frame.num_rows:
                values = frame.column(0).flatten().to_numpy(zero_copy_only=False)
                yield pa.record_batch({
                    "n": pa.array([frame.num_rows], pa.int64()), "d": pa.array([len(values) // frame.num_rows], pa.int32()),
                    "block": pa.array([values.tobytes()], pa.binary()),
                })

    return run


def _first_drawn() -> Callable[[tuple, tuple], tuple]:
    """Of two draws of rows, for each restart the one that comes first; the smaller row of equals."""
    def run(a: tuple, b: tuple) -> tuple:
        best, rows = a[0].copy(), a[1].copy()
        for r, (race, row) in enumerate(zip(*b)):
            if (race, row.tolist()) < (best[r], rows[r].tolist()):
                best[r], rows[r] = race, row
        return best, rows

    return run


def _candidates(centres: np.ndarray, seed: int, turn: int) -> Callable[[Iterator], Iterator[tuple]]:
    """For each restart, the row of the task whose draw comes first if rows are drawn by squared distance."""
    def run(blocks: Iterator) -> Iterator[tuple]:
        restarts, k, d = centres.shape
        best, rows = np.full(restarts, np.inf), np.zeros((restarts, d))
        for block in blocks:
            x = np.frombuffer(block["block"]).reshape(-1, d)
            # A draw in (0, 1] for each row and restart, from the row's values alone: however rows lie, the same row wins.
            mixed = np.full(len(x), (seed * 1_000_003 + turn) & 0xFFFFFFFF, np.uint64)
            for j in range(d):
                mixed = (mixed ^ x[:, j].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            for r in range(restarts):
                own = (mixed + np.uint64(r + 1)) * np.uint64(0xBF58476D1CE4E5B9)
                own = (own ^ (own >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                unit = ((own >> np.uint64(11)) + np.uint64(1)) / float(1 << 53)
                weight = np.ones(len(x))
                if k:
                    weight = np.min(((x[:, None, :] - centres[r][None]) ** 2).sum(axis=2), axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    race = np.where(weight > 0, -np.log(unit) / weight, np.inf)
                first = int(np.argmin(race))
                if race[first] < best[r]:
                    best[r], rows[r] = race[first], x[first]
        yield best, rows

    return run


def _sums(own: np.ndarray) -> Callable[[Iterator], Iterator[tuple]]:
    """Of each restart and centre: the rows nearest to it, their squared distances, and their sum."""
    def run(blocks: Iterator) -> Iterator[tuple]:
        live, k, d = own.shape
        counts, costs, totals = np.zeros(live * k), np.zeros(live * k), np.zeros((live * k, d))
        for block in blocks:
            whole = np.frombuffer(block["block"]).reshape(-1, d)
            for at in range(0, len(whole), 4096):
                x = whole[at: at + 4096]
                gaps = (x * x).sum(axis=1)[:, None] - 2 * (x @ own.reshape(-1, d).T) + (own * own).sum(axis=2).reshape(1, -1)
                near = gaps.reshape(len(x), live, k).argmin(axis=2)
                chosen = (near[:, :, None] == np.arange(k)).reshape(len(x), -1)
                counts += chosen.sum(axis=0)
                costs += np.where(chosen, np.maximum(gaps, 0), 0.0).sum(axis=0)
                totals += chosen.T.astype(float) @ x
        yield counts.reshape(live, k), costs.reshape(live, k), totals.reshape(live, k, d)

    return run


def best_kmeans(vectors: DataFrame, column: str, k: int = 4, restarts: int = RESTARTS, seed: int = SEED) -> Centres:
    """Fit from several starts and keep the centres with the lowest cost; ``column`` holds arrays of double.

    The rows are cached as blocks of bytes. All restarts move together: each pass over the blocks gives the sums for the
    centres of every restart that has not settled, so there are k passes to draw the starts (each centre a row drawn by its
    squared distance from those before, equal rows counting once) and then as many as the longest restart needs. A pass is
    one job without an exchange of rows, of as many tasks as the vectors fill (not as their table has partitions); what
    reaches the driver is the figures of each restart and centre, merged in a tree. Sums are added up task by task; the
    last digits of the centres may depend on that order. Rows with a null vector are left out; a table with fewer than k
    different rows has fewer centres.
    """
    rows = vectors.select(column).where(F.col(column).isNotNull())
    blocks = rows.mapInArrow(_packing(), "n long, d int, block binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = blocks.agg(F.sum("n").alias("n"), F.max("d").alias("d")).first()
        d = size["d"] or 0
        parts = blocks.rdd.coalesce(max(1, -(-(size["n"] or 0) * d // _VALUES_A_TASK)))
        centres = np.zeros((restarts, 0, d))
        passes = 0
        for turn in range(k if size["n"] else 0):
            race, drawn = parts.mapPartitions(_candidates(centres, seed, turn)).treeReduce(_first_drawn())
            passes += 1
            if not np.isfinite(race).all():
                break  # no row is left that is no centre
            centres = np.concatenate([centres, drawn[:, None]], axis=1)
        live, costs = list(range(restarts)) if centres.shape[1] else [], np.zeros(restarts)
        for _ in range(MAX_ITERATIONS):
            if not live:
                break
            n, cost, total = parts.mapPartitions(_sums(centres[live])).treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))
            passes += 1
            costs[live] = cost.sum(axis=1)
            moved = centres.copy()
            moved[live] = np.where(n[:, :, None] > 0, total / np.maximum(n, 1)[:, :, None], centres[live])  # a centre without rows stays where it is
            moves = ((moved - centres) ** 2).sum(axis=(1, 2))
            live = [r for r in live if moves[r] > TOLERANCE]
            centres = moved
        best = int(np.argmin(costs))
        return Centres(centres[best], float(costs[best]), passes)
    finally:
        blocks.unpersist()


def kmeans(df: DataFrame, features: Sequence[str], k: int = 4, restarts: int = RESTARTS, seed: int = SEED, out: str = "cluster", order_by: str | None = None) -> DataFrame:
    """Add a group id per row, found on the standardised features; nulls read as 0.

    Ids are canonical: 0 is the group with the highest mean of ``order_by``
    (default: the first feature), ties broken by size.
    """
    filled = {f"_x{i}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for i, f in enumerate(features)}
    vectors = VectorAssembler(inputCols=list(filled), outputCol="_vector").transform(df.withColumns(filled)).drop(*filled)
    return kmeans_vectors(vectors, "_vector", k, restarts, seed, out, order_by or features[0]).drop("_vector")


def kmeans_vectors(df: DataFrame, column: str, k: int = 4, restarts: int = RESTARTS, seed: int = SEED, out: str = "cluster", order_by: str | None = None) -> DataFrame:
    """As ``kmeans``, on a vector column. Without ``order_by``, group 0 is the largest.

    The input is read once to fit (the needed columns are cached meanwhile) and once more when the result is used. MLlib
    scales by the n - 1 deviation; against the n divisor that is one common factor for all features, which moves no row
    to another group.
    """
    needed = df.select(column, *([order_by] if order_by else [])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scaler = StandardScaler(inputCol=column, outputCol="_scaled", withMean=True, withStd=True).fit(needed)
        scaled = scaler.transform(needed).withColumn("_scaled", vector_to_array("_scaled"))
        centres = best_kmeans(scaled, "_scaled", k, restarts, seed)
        order = _id_order(scaled.withColumn("_raw", centres.nearest(F.col("_scaled"))), "_raw", order_by)
    finally:
        needed.unpersist()
    placed = scaler.transform(df).withColumn("_raw", centres.nearest(vector_to_array("_scaled")))
    return _renumber(placed.drop("_scaled"), "_raw", order, out)


def canonical_ids(df: DataFrame, raw: str, order_by: str | None, out: str = "cluster") -> DataFrame:
    """Renumber k group ids by falling mean of ``order_by``, then size."""
    return _renumber(df, raw, _id_order(df, raw, order_by), out)


def _id_order(df: DataFrame, raw: str, order_by: str | None) -> list[int]:
    """The k group ids in canonical order; nothing else reaches the driver."""
    mean = F.avg(order_by) if order_by else F.lit(0)
    sizes = df.groupBy(raw).agg(mean.alias("_m"), F.count(F.lit(1)).alias("_n"))
    return [row[0] for row in sizes.orderBy(F.col("_m").desc_nulls_last(), F.desc("_n"), raw).select(raw).collect()]


def _renumber(df: DataFrame, raw: str, order: Sequence[int], out: str) -> DataFrame:
    if not order:
        return df.withColumnRenamed(raw, out)
    pairs = [F.lit(x) for new, old in enumerate(order) for x in (old, new)]
    return df.withColumn(out, F.try_element_at(F.create_map(*pairs), F.col(raw))).drop(raw)
