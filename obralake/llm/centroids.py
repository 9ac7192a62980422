"""Centroid clustering of integer vectors by equal-average equal-variance search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

#: Greatest value of a long.
MOST = (1 << 63) - 1


def _plain(rows: np.ndarray) -> np.ndarray:
    """Rows of 64-bit integers where all that is computed of them fits, else of integers of any size."""
    most = (1 << 30) // max(1, rows.shape[1])
    if rows.size and max(int(rows.max()), -int(rows.min())) > most:
        return rows.astype(object)
    return rows.astype(np.int64)


class Centroids:
    """Centroids sorted by component mean.

    Means and deviations are kept as sums S and as n |x|^2 - S^2, integers that need no division. The
    squared distance of two vectors of n components is at least ((S - S')^2 + (V - V')^2) / n, where V
    is the root of the second number.
    """

    def __init__(self, places: list[list[int]]):
        self.rows = _plain(np.array(places, object).reshape(len(places), -1 if places else 0))
        sums, deviations = self._mean_and_deviation(self.rows)
        order = np.lexsort((np.arange(len(places)), sums.astype(float)))
        self.number, self.rows = order, self.rows[order]
        self.sums, self.deviations = sums[order], deviations[order]

    @staticmethod
    def _mean_and_deviation(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = rows.sum(1)
        spread = rows.shape[1] * (rows * rows).sum(1) - sums * sums
        return sums, np.sqrt(spread.astype(float))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, ties to the smaller number,
        and the distances computed.

        Every row scans outward from its own mean. A side ends with the first centroid whose mean alone
        rules it out; a centroid whose deviation rules it out is passed over. What is left is compared
        as integers. Bounds are lowered by more than their rounding.
        """
        if self.rows.dtype == object:
            rows = rows.astype(object)
        n, k = rows.shape[1], len(self.rows)
        sums, deviations = self._mean_and_deviation(rows)
        means = self.sums.astype(float)
        right = np.searchsorted(means, sums.astype(float))
        left = right - 1
        best = np.zeros(len(rows), rows.dtype)
        winner = np.full(len(rows), -1)
        bound = np.full(len(rows), np.inf)
        at, computed = np.arange(len(rows)), 0
        gaps = np.r_[np.inf, means, np.inf]  # a side that is past its end is infinitely far
        gaps[0] = -np.inf
        while len(at):
            own = sums[at].astype(float)
            low, high = own - gaps[left[at] + 1], gaps[right[at] + 1] - own
            to_left = low <= high
            gap = np.where(to_left, low, high)
            open_ = gap * gap * (1 - 1e-12) <= bound[at] * n  # else both sides have ended
            open_ &= np.isfinite(gap)
            at, to_left, gap = at[open_], to_left[open_], gap[open_]
            c = np.where(to_left, left[at], right[at])
            apart = np.abs(deviations[at] - self.deviations[c])
            slack = 1e-9 * (deviations[at] + self.deviations[c])
            apart = np.maximum(apart - slack, 0)
            near = (gap * gap + apart * apart) * (1 - 1e-12) <= bound[at] * n
            i, j = at[near], c[near]
            computed += len(i)
            d = rows[i] - self.rows[j]
            d = (d * d).sum(1)
            better = (winner[i] < 0) | (d < best[i]) | ((d == best[i]) & (self.number[j] < winner[i]))
            i, d, j = i[better], d[better], j[better]
            best[i], winner[i], bound[i] = d, self.number[j], d.astype(float)
            left[at] -= to_left
            right[at] += ~to_left
        return winner, best, computed


def quantised(rows: DataFrame, size: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """`id` and `v` (floor of `scale` times each component) of vectors of `size` finite components.

    A component past the range of long takes its end.
    """
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) == size) & ~bad).select(
        F.col(id_col).alias("id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def starts(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The `k` vectors with the smallest hashes of their ids, ties by the vector; null ids come last."""
    text = F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))
    rows = vectors.orderBy(F.sha2(text, 256).asc_nulls_last(), "v").select("v").limit(k)
    return [list(r.v) for r in rows.collect()]


def _rows(column: pa.Array, n: int) -> np.ndarray:
    return _plain(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), n))


def _assigned(batches: Iterator[pa.RecordBatch], at: int, centroids: Centroids, n: int
              ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            rows = _rows(batch.column(at), n)
            number, distance, _ = centroids.nearest(rows)
            yield batch, rows, number, distance


def _sums(vectors: DataFrame, centroids: Centroids, n: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each centroid's vectors, added up in the tasks first."""
    k = len(centroids.rows)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, n + 1), object)
        for _, rows, number, _ in _assigned(batches, 0, centroids, n):
            for c in np.unique(number):
                held = rows[number == c]
                total[c] += np.r_[held.sum(0).astype(object), len(held)]
        c, part = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(part, pa.int32()), pa.array([str(x) for x in total[c, part]])],
            names=["cluster", "part", "n"])

    found = vectors.select("v").mapInArrow(add, "cluster int, part int, n string").groupBy(
        "cluster", "part").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    sums = [[0] * (n + 1) for _ in range(k)]
    for r in found.collect():  # k rows for each component
        sums[r.cluster][r.part] = int(r.n)
    return {c: (row[-1], row[:-1]) for c, row in enumerate(sums) if row[-1]}


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024,
            seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Nearest of `k` centroids for each vector after `rounds` rounds, all in integers.

    Only the centroids and their sums meet in one place; a round is a scan of the stored vectors whose
    tasks add up their own first. Means are rounded down; a centroid without vectors stays.

    Columns: the id, `cluster`, `distance` (squared), `cluster_inertia`, `inertia`, `centroid_sha256`.
    Vectors of another length than `size`, null ones, and those that hold null or non-finite
    components take no part; a null id takes part but is the last to start a centroid; every row
    counts, repeated ones too; ties go to the smaller number; an empty table gives no rows; with fewer
    vectors than `k` there are as many centroids; other columns are not read. Components of any size
    are exact up to the range of long; greater distances and inertias are given as its end.
    """
    kept = store(quantised(vectors, size, scale, id_col, vector_col), "vectors")
    id_type = kept.schema["id"].dataType.simpleString()
    places = starts(kept, k, seed)
    for _ in range(rounds if places else 0):
        for c, (n, sums) in _sums(kept, Centroids(places), size).items():
            places[c] = [s // n for s in sums]
    centroids = Centroids(places)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, distance in _assigned(batches, 1, centroids, size):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int32()),
                 pa.array([min(int(d), MOST) for d in distance], pa.int64())],
                names=["id", "cluster", "distance"])

    found = store(kept.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row a centroid
    names = [(c, min(inertia.get(c, 0), MOST), hashlib.sha256(",".join(map(str, place)).encode()).hexdigest())
             for c, place in enumerate(places)]
    named = vectors.sparkSession.createDataFrame(
        names, "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(named, "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
        F.lit(min(sum(inertia.values()), MOST)).alias("inertia"), "centroid_sha256")
