"""Exact nearest vectors by clipped dot product, with triangle-inequality pruning.

Items are assigned to the nearest of a fixed number of pivots. A query visits a cell only if the
cell's angular extent allows a hit as good as its current k-th best. Cells and their visitors are
cut into blocks of bounded size, so a cell that holds a third of all vectors is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

PIVOTS = 64
BLOCK = 4_096
# Queries that a task compares, or deals to cells, at once.
ROWS = 256
MARGIN = 1e-6
DIGITS = 9


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("float64")


def _angles(vectors: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angle of each vector to each pivot, and the vectors' norms."""
    norms = np.linalg.norm(vectors, axis=1)
    cosines = vectors @ units.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0)), norms


def _matches(asking: pd.DataFrame, offered: pd.DataFrame, k: int) -> pd.DataFrame:
    """Hits of a block that may be among the k best, ROWS of its queries at a time."""
    if not len(asking) or not len(offered):
        return pd.DataFrame({"sid": [], "iid": [], "emb": []})
    ids, vectors = offered["iid"].to_numpy(), _matrix(offered["v"]).T
    out = []
    for at in range(0, len(asking), ROWS):
        some = asking.iloc[at:at + ROWS]
        sims = np.round(np.clip(_matrix(some["v"]) @ vectors, 0.0, 1.0), DIGITS)
        floor = some["floor"].to_numpy() - MARGIN
        if sims.shape[1] > k:
            floor = np.maximum(floor, np.partition(sims, -k, axis=1)[:, -k])
        row, col = np.nonzero(sims >= floor[:, None])
        found = pd.DataFrame({"sid": some["sid"].to_numpy()[row], "iid": ids[col], "emb": sims[row, col]})
        # Equal copies can all reach the floor: the k highest ids of a block are enough.
        out.append(found.sort_values(["emb", "iid"], ascending=False).groupby("sid").head(k))
    return pd.concat(out)


def _id_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def vector_topk(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str,
                vector: str = "embedding", pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """The k best items of each query: query_id, item_id, emb, posto; ties go to the higher id."""
    found = _visit(queries, items, k, query_id, item_id, vector, pivots, block)
    best = Window.partitionBy("sid").orderBy(F.desc("emb"), F.desc("iid"))
    return found.withColumn("posto", F.row_number().over(best)).filter(F.col("posto") <= k).select(
        F.col("sid").alias(query_id), F.col("iid").alias(item_id), "emb", "posto")


def _visit(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str,
           vector: str, pivots: int, block: int) -> DataFrame:
    """Candidate hits of each query; rows without a vector take no part."""
    qtype, itype = _id_type(queries, query_id), _id_type(items, item_id)
    qs = queries.filter(F.col(vector).isNotNull()).select(
        F.col(query_id).alias("sid"), F.col(vector).alias("v"), F.lit(0.0).alias("floor"))
    its = items.filter(F.col(vector).isNotNull()).select(F.col(item_id).alias("iid"), F.col(vector).alias("v"))

    # Pivots, cell extents and seeds are bounded by `pivots` and k, not by the data.
    chosen = its.orderBy(F.md5(F.col("iid").cast("string")), "iid").limit(pivots).collect()
    if not chosen:
        return items.sparkSession.createDataFrame([], f"sid {qtype}, iid {itype}, emb double")
    raw = np.array([r["v"] for r in chosen], dtype="float64")
    norms = np.linalg.norm(raw, axis=1)
    units = raw[norms > 0] / norms[norms > 0][:, None]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                angle, norm = _angles(_matrix(b["v"]), units)
                cell = angle.argmin(axis=1)
                yield b.assign(cell=cell.astype("int32"), norm=norm,
                               angle=angle[np.arange(len(b)), cell])

    placed = store(its.mapInPandas(
        assign, f"iid {itype}, v array<double>, cell int, norm double, angle double"), "placed")
    extent = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.max("norm").alias("norm"),
        F.count("*").alias("n")).collect()}
    central = Window.partitionBy("cell").orderBy("angle", "iid")
    seed_rows = placed.withColumn("r", F.row_number().over(central)).filter(
        F.col("r") <= k).select("v").collect()
    seeds = np.array([r["v"] for r in seed_rows], dtype="float64")
    cells = np.array(sorted(extent))
    low = np.array([extent[c]["lo"] for c in cells])
    high = np.array([extent[c]["hi"] for c in cells])
    longest = np.array([extent[c]["norm"] for c in cells])

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (batch.iloc[at:at + ROWS] for batch in batches for at in range(0, len(batch), ROWS)):
            m = _matrix(b["v"])
            floor = b["floor"].to_numpy()
            if len(seeds) >= k:
                near = np.clip(m @ seeds.T, 0.0, 1.0)
                floor = np.partition(near, -k, axis=1)[:, -k]
            angle, norm = _angles(m, units)
            angle = angle[:, cells]
            gap = np.maximum(0.0, np.maximum(angle - high, low - angle))
            bound = np.clip(norm[:, None] * longest * np.cos(gap), 0.0, None)
            row, col = np.nonzero(bound >= floor[:, None] - MARGIN)
            yield pd.DataFrame({"sid": b["sid"].to_numpy()[row], "v": b["v"].to_numpy()[row],
                                "floor": floor[row], "cell": cells[col].astype("int32")})

    routed = store(qs.mapInPandas(
        route, f"sid {qtype}, v array<double>, floor double, cell int"), "routed")
    visits = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(
        F.count("*").alias("n")).collect()}
    pieces = F.create_map(*[F.lit(x) for c in extent for x in (
        int(c), max(1, -(-extent[c]["n"] // block)))])
    crowds = F.create_map(*[F.lit(x) for c in extent for x in (
        int(c), max(1, -(-visits.get(c, 0) // block)))])
    piece, crowd = pieces[F.col("cell")], crowds[F.col("cell")]
    sides = placed.select(
        "cell", F.pmod(F.xxhash64("iid"), piece).cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), crowd - 1)).alias("crowd"), "iid", "v")
    askers = routed.select(
        "cell", F.explode(F.sequence(F.lit(0), piece - 1)).alias("piece"),
        F.pmod(F.xxhash64("sid"), crowd).cast("int").alias("crowd"), "sid", "v", "floor")

    def match(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        return _matches(asking, offered, k)

    key = ["cell", "piece", "crowd"]
    return askers.groupBy(*key).cogroup(sides.groupBy(*key)).applyInPandas(
        match, f"sid {qtype}, iid {itype}, emb double")
