"""Order-dependent picks as mergeable aggregates (no window, no arbitrary survivor)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        choose(F.struct(*rest), F.struct(*order)).alias("_kept"))
    return picked.select(*keys, *[F.col("_kept")[c].alias(c) for c in rest])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first in `order`."""
    return _pick(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes last in `order`."""
    return _pick(df, keys, order, F.max_by)


def union_by_priority(*frames: DataFrame, rank: str = "rank") -> DataFrame:
    """Concatenate sources in priority order, tagged with their position."""
    tagged = [f.withColumn(rank, F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for other in tagged[1:]:
        out = out.unionByName(other)
    return out


def new_keys(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def existing_keys(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stored.join(incoming.select(*keys), list(keys), "left_semi")


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """Stored rows whose key does not arrive, plus the incoming rows, the last in `order` per key.

    Rows that are equal in `order` are told apart by all their columns, so the result does not depend
    on how rows are dealt.
    """
    cols = stored.columns
    last = last_wins(incoming, keys, [*order, *[c for c in incoming.columns
                                               if c not in keys and c not in order]])
    return new_keys(stored, incoming, keys).select(*cols).unionByName(last.select(*cols))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copias")).filter(F.col("copias") > 1)
