"""Exact top-k by inner product: best-first search in M-trees of paged metric nodes."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import store

#: Entries of a page, and pivots of the root page.
PAGE, ROOT = 64, 256
#: Inner products below this are exact as doubles.
EXACT = float(1 << 53)
#: Ends of the range of long.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


class MTree:
    """M-tree of vectors, built in bulk.

    Inner products become distances by one more component, sqrt(M - |x|^2) for a vector x and 0 for a
    query, where M is the largest squared norm: the nearest vector has the greatest inner product.
    An inner page holds, for each child page, its pivot, covering radius and the pivot's distance to
    the page's own pivot; a leaf page holds rows and their distances to its pivot.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.whole = ids[order], rows[order]
        self.rows = self.whole.astype(np.float64)
        norms = (self.rows ** 2).sum(1)
        self.reach = norms.max()
        self.points = np.c_[self.rows, np.sqrt(self.reach - norms)]
        self.pages: list[tuple] = []
        self.root, self.pivot, _ = self._build(np.arange(len(ids)))
        del self.points  # only needed to build

    def _build(self, at: np.ndarray) -> tuple[int, np.ndarray, float]:
        points = self.points[at]
        centre = points[_distances(points, points.mean(0)[None])[:, 0].argmin()]
        away = _distances(points, centre[None])[:, 0]
        if len(at) <= PAGE:
            near = np.argsort(away, kind="stable")
            self.pages.append((True, at[near], away[near]))
            return len(self.pages) - 1, centre, float(away.max())
        fan = min(PAGE, max(2, -(-len(at) // PAGE)))
        pivots = [int(away.argmax())]
        least = _distances(points, points[pivots])[:, 0]
        while len(pivots) < fan and least.max() > 0:  # the farthest from all pivots so far
            pivots.append(int(least.argmax()))
            least = np.minimum(least, _distances(points, points[pivots[-1:]])[:, 0])
        nearest = _distances(points, points[pivots]).argmin(1)
        parts = [at[nearest == i] for i in range(len(pivots))]
        parts = [p for p in parts if len(p)]
        if len(parts) < 2:  # equal points
            parts = np.array_split(at, fan)
        children = [self._build(p) for p in parts]
        child = np.array([c for c, _, _ in children])
        places = np.array([p for _, p, _ in children])
        self.pages.append((False, child, places, np.array([r for _, _, r in children]),
                           _distances(places, centre[None])[:, 0]))
        return len(self.pages) - 1, centre, float(away.max())

    def search(self, query: np.ndarray, k: int, own: int | None, floor: float = -np.inf
               ) -> tuple[list[tuple[int, int]], int]:
        """The k greatest inner products of at least `floor` as (score, id), and the distances computed.

        Pages are taken nearest first. The distance of an entry is computed only if the stored
        distances, by the triangle inequality, leave room for it to be among the k.
        """
        plain = query.astype(np.float64)
        exact = np.sqrt(plain @ plain) * np.sqrt(self.reach) < EXACT
        q = np.r_[plain, 0.0]
        length = q @ q + self.reach
        slack = 1e-7 * (1 + np.sqrt(length))
        limit = np.sqrt(max(0.0, length - 2 * floor)) + slack if floor > -np.inf else np.inf
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        first = float(np.sqrt(((q - self.pivot) ** 2).sum()))
        queue = [(0.0, self.root, first)]
        computed = 1

        def take(at: np.ndarray) -> None:
            nonlocal limit
            if exact:
                scores = self.rows[at] @ plain
            else:  # integers of any size
                scores = (self.whole[at].astype(object) * query.astype(object)).sum(1)
            good = np.flatnonzero(scores >= (best[0][0] if len(best) == k else floor))
            # One may be the query's own.
            for i in sorted(good.tolist(), key=lambda i: (-scores[i], self.ids[at[i]]))[:k + 1]:
                s, row = int(scores[i]), int(self.ids[at[i]])
                if row == own or s < floor:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -row))
                elif (s, -row) > best[0]:
                    heapq.heapreplace(best, (s, -row))
            if len(best) == k:
                limit = min(limit, np.sqrt(max(0.0, length - 2 * best[0][0])) + slack)

        while queue:
            low, page, here = heapq.heappop(queue)
            if low > limit:
                break
            leaf, entries, *rest = self.pages[page]
            if leaf:
                at = entries[np.abs(here - rest[0]) <= limit]
                computed += len(at)
                if len(at):
                    take(at)
                continue
            places, radius, apart = rest
            open_ = np.flatnonzero(np.abs(here - apart) - radius <= limit)
            if not len(open_):
                continue
            d = np.sqrt(((places[open_] - q) ** 2).sum(1))
            computed += len(open_)
            near: list[tuple[float, float, int]] = []
            for i, x in zip(open_, d):
                low = max(0.0, x - radius[i])
                if low <= limit:
                    near.append((low, float(x), int(entries[i])))
            if floor > -np.inf:  # the limit is known, so leaves of a page are read together
                leaves = [(x, self.pages[c]) for _, x, c in sorted(near) if self.pages[c][0]]
                near = [t for t in near if not self.pages[t[2]][0]]
                if leaves:
                    at = np.concatenate([p[1] for _, p in leaves])
                    away = np.concatenate([p[2] for _, p in leaves])
                    at = at[np.abs(np.repeat([x for x, _ in leaves], [len(p[1]) for _, p in leaves]) - away) <= limit]
                    computed += len(at)
                    if len(at):
                        take(at)
            for low, x, c in near:
                heapq.heappush(queue, (low, c, x))
        return [(s, -i) for s, i in sorted(best, reverse=True)], computed


def quantised(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """`id`, `v` (floor of `scale` times each component) of vectors without null or non-finite parts."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


class Root:
    """Root page: pivots of each vector length with their rows' greatest squared norm and covering radii.

    Points are those of `MTree`, with the greatest norm of all rows of a length. Rows of a length that has
    no pivot are place -1.
    """

    def __init__(self, pivots: list[list[int]], reach: dict[int, float]):
        self.reach, self.radius = reach, {}
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(p) for p in pivots}:
            numbers = np.array([i for i, p in enumerate(pivots) if len(p) == n])
            rows = np.array([pivots[i] for i in numbers], np.float64).reshape(len(numbers), n)
            self.at[n] = numbers, np.c_[rows, np.sqrt(np.maximum(reach[n] - (rows * rows).sum(1), 0))]

    def distances(self, rows: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pivots of this length, and the distance of each row to each of them."""
        n = rows.shape[1]
        if n not in self.at:
            return np.array([-1]), np.zeros((len(rows), 1))
        last = np.zeros(len(rows)) if query else np.sqrt(np.maximum(self.reach[n] - (rows * rows).sum(1), 0))
        numbers, points = self.at[n]
        return numbers, _distances(np.c_[rows, last], points)


def _by_length(b: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    sizes = b["v"].map(len)
    for n in sorted(sizes.unique()):
        some = b[sizes == n]
        yield some, np.array(some["v"].tolist(), np.int64).reshape(len(some), n)


def top_inner_products(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256,
                       id_col: str = "vec_id", vector_col: str = "embedding",
                       tree_rows: int | None = None, block: int = 2048) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of each query's `k` greatest integer inner products.

    One M-tree over all tasks: its root page holds up to ROOT pivots, chosen by a hash of the ids, and
    every row belongs to the nearest; below a pivot hang subtrees of about `tree_rows`, each built once
    by a task. A query searches what hangs below its nearest pivot, whose k-th score is the floor; of the
    other subtrees it is sent only to those that the covering radius of their pivot leaves room in. At
    most `block` queries meet a subtree in one task. Vectors are compared with those of their own length.

    A row with the query's own id is no candidate. Vectors that are null or hold null or non-finite
    components take no part, nor do rows without an id; empty vectors have inner product 0. Repeated
    rows count as one, rows of one id and different vectors as one (the least vector); ties go to the
    smaller id; an empty table gives no rows; other columns are not read. Scores of any size are exact
    and ranked as such; those past the range of long are given as its end.
    """
    def settled(table: DataFrame) -> DataFrame:
        return quantised(table, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))

    base = store(settled(rows), "vectors")
    count = base.count()
    size = tree_rows or int(min(65_536, max(2048, 16 * count ** 0.5)))
    chosen = base.orderBy(F.md5(F.col("id").cast("string"))).limit(min(ROOT, -(-count // size))).select("v").collect()
    pivots = [list(r.v) for r in chosen]
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    reach = {r.n: r.reach for r in base.groupBy(F.size("v").alias("n")).agg(F.max(norm).alias("reach")).filter(
        F.col("n").isin(sorted({len(p) for p in pivots}))).collect()}
    root = Root(pivots, reach)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for some, points in _by_length(b) if len(b) else ():
                numbers, away = root.distances(points.astype(np.float64), False)
                at = away.argmin(1)
                yield some.assign(n=points.shape[1], pivot=numbers[at], away=away[np.arange(len(some)), at])

    placed = store(base.mapInPandas(place, "id long, v array<long>, n int, pivot int, away double"), "placed")
    below = store(placed.groupBy("n", "pivot").agg(F.ceil(F.count("*") / size).cast("int").alias("cuts"),
                                                   F.max("away").alias("radius")), "below")
    root.radius = {r.pivot: r.radius for r in below.filter("pivot >= 0").collect()}  # ROOT rows at most

    def build(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        points = np.array(b["v"].tolist(), np.int64).reshape(len(b), -1)
        return pd.DataFrame({"n": [key[0]], "pivot": [key[1]], "cut": [key[2]],
                             "tree": [pickle.dumps(vars(MTree(b["id"].to_numpy(), points)))]})

    trees = store(placed.join(below.drop("radius"), ["n", "pivot"]).withColumn(
        "cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")).select("id", "v", "n", "pivot", "cut").groupBy(
        "n", "pivot", "cut").applyInPandas(build, "n int, pivot int, cut int, tree binary"), "trees")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for some, points in _by_length(b) if len(b) else ():
                points = points.astype(np.float64)
                n = points.shape[1]
                numbers, away = root.distances(points, True)
                low = away - np.array([root.radius.get(int(p), np.inf) for p in numbers])
                nearest = away.argmin(1)
                length = (points * points).sum(1) + root.reach.get(n, 0.0)
                for j, p in enumerate(numbers):
                    yield pd.DataFrame({"id": some["id"], "v": some["v"], "n": n, "pivot": p, "low": np.maximum(low[:, j], 0),
                                        "length": length, "first": nearest == j})

    routed = store(settled(queries).mapInPandas(
        route, "id long, v array<long>, n int, pivot int, low double, length double, first boolean"), "routed")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            tree = MTree.__new__(MTree)
            vars(tree).update(pickle.loads(left["tree"].iloc[0]))
            for i, floor, v in zip(right["id"], right["floor"], right["v"]):
                found, computed = tree.search(np.array(v, np.int64), k, int(i), -np.inf if floor != floor else floor)
                out += [(int(i), row, str(s), min(max(s, LEAST), MOST), computed) for s, row in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "exact", "score", "computed"])

    def search(visits: DataFrame, name: str) -> DataFrame:
        there = visits.join(below.drop("radius"), ["n", "pivot"]).withColumn(
            "cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).drop("cuts")
        crowds = store(there.groupBy("n", "pivot", "cut").agg(
            F.ceil(F.count("*") / block).cast("int").alias("parts")), "crowds")
        key = ["n", "pivot", "cut"]
        guests = there.join(crowds, key).withColumn("part", F.pmod(F.hash("id"), F.col("parts")).cast("int"))
        hosts = trees.join(crowds, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return store(hosts.select(*key, "part", "tree").groupBy(*key, "part").cogroup(
            guests.select(*key, "part", "id", "v", "floor").groupBy(*key, "part")).applyInPandas(
            run, "query_id long, vec_id long, exact string, score long, computed long"), name)

    # Scores below 2^63 decide as they are; of greater ones, sign and digits do.
    big = F.length("exact")
    order = W.partitionBy("query_id").orderBy(
        F.desc("score"), F.desc(F.when(F.col("score") == MOST, big).when(F.col("score") == LEAST, -big)),
        F.when(F.col("score") == MOST, F.col("exact")).desc(), F.when(F.col("score") == LEAST, F.col("exact")), "vec_id")
    near = search(routed.filter("first").withColumn("floor", F.lit(None).cast("double")), "near")
    floors = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k).select(
        F.col("query_id").alias("id"), F.col("exact").cast("double").alias("floor"))
    reach_of = F.sqrt(F.greatest(F.lit(0.0), F.col("length") - 2 * F.col("floor"))) + 1e-7 * (1 + F.sqrt("length"))
    far = routed.filter(~F.col("first")).join(floors, "id", "left").filter(
        F.col("floor").isNull() | (F.col("low") <= reach_of)).withColumn(
        "floor", F.col("floor") - F.abs("floor") * 1e-12)
    found = near.unionByName(search(far, "far"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
