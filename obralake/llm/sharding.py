"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import store
from .differencing import deal, difference

#: Groups dealt by one task, and partial partitions merged by one task.
BLOCK, MERGED = 20_000, 500


def deal_groups(groups: DataFrame, k: int) -> DataFrame:
    """Lane of each group: rows (`key`, `bytes`) to (`key`, `lane`).

    Each block of groups becomes a partial partition of k lanes; blocks are then merged, many to one,
    until a single partition is left.
    """
    blocks = max(1, -(-groups.count() // BLOCK))

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
        return pdf.assign(lane=deal(pdf["bytes"].to_numpy(), k))[["block", "key", "bytes", "lane"]]

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        loads = pdf.pivot_table(index="block", columns="lane", values="bytes", aggfunc="sum",
                                fill_value=0).reindex(columns=range(k), fill_value=0).sort_index()
        to = difference(loads.to_numpy(np.int64))
        return pd.DataFrame({"block": np.repeat(loads.index.to_numpy(), k),
                             "lane": np.tile(np.arange(k), len(loads)), "to": to.ravel(),
                             "bytes": loads.to_numpy().ravel()})

    dealt = store(groups.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("long"))
                  .groupBy("block").applyInPandas(first, "block long, key string, bytes long, lane int"),
                  "lanes")
    level = store(dealt.groupBy("block", "lane").agg(F.sum("bytes").alias("bytes")), "loads")
    places = None
    while blocks > 1:
        blocks = -(-blocks // MERGED)
        merged = store(level.withColumn("up", F.floor(F.col("block") / MERGED)).groupBy("up")
                       .applyInPandas(lambda key, pdf: merge(pdf).assign(up=key[0]),
                                      "block long, lane int, to int, bytes long, up long"), "merged")
        level = store(merged.groupBy(F.col("up").alias("block"), F.col("to").alias("lane"))
                      .agg(F.sum("bytes").alias("bytes")), "loads")
        step = merged.select("block", "lane", F.col("up").alias("block_to"), F.col("to").alias("lane_to"))
        places = step if places is None else places.join(
            step.select(F.col("block").alias("block_to"), F.col("lane").alias("lane_to"),
                        F.col("block_to").alias("b"), F.col("lane_to").alias("l")),
            ["block_to", "lane_to"]).select("block", "lane", F.col("b").alias("block_to"),
                                            F.col("l").alias("lane_to"))
    if places is None:
        return dealt.select("key", "lane")
    return dealt.join(places, ["block", "lane"]).select("key", F.col("lane_to").alias("lane"))


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Put documents into `shards` of nearly equal bytes; equal texts stay together.

    The size of a document is its UTF-8 bytes plus 16; a null text counts as empty and goes with the
    empty ones. The law that holds is `bytes`: no group is divided, so a group of copies larger than
    the mean sets its own shard's size and the others share what is left. Repeated rows get a slot
    each; ties go by key; an empty table gives no rows; other columns are not read. With fewer
    groups than shards some shards stay empty.

    Columns: the id, `size`, `text_crc32`, `law`, `shard`, `slot` (gapless in the shard), `grown_shard`
    (null).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    data = F.encode(text, "UTF-8")
    meta = store(docs.select(
        F.col(id_col), (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(data).alias("text_crc32"), F.md5(data).alias("key")), "sizes")
    groups = store(meta.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    lanes = store(deal_groups(groups, shards), "shards")
    rows = meta.count()
    spread = max(8, -(-rows // 400_000))
    placed = store(meta.join(lanes, "key").withColumn(
        "spread", F.pmod(F.xxhash64(id_col, "text_crc32", "size"), F.lit(spread))), "placed")
    counts = placed.groupBy("lane", "spread").agg(F.count("*").alias("n"))
    before = counts.select("lane", "spread", (F.sum("n").over(
        W.partitionBy("lane").orderBy("spread")) - F.col("n")).alias("before"))
    numbered = placed.withColumn("at", F.row_number().over(
        W.partitionBy("lane", "spread").orderBy(id_col, "text_crc32", "size")))
    return numbered.join(before, ["lane", "spread"]).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), F.col("lane").alias("shard"),
        (F.col("before") + F.col("at") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
