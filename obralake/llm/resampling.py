"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import store
from .keys import row_key
from .tasks import release

#: Longest n-gram in words, and buckets that n-grams are hashed to.
LONGEST, BUCKETS = 2, 10_000
#: Words of a document that may be drawn, and the share that is drawn, in percent.
LEAST_WORDS, SHARE = 20, 25

#: Bytes as they are in an n-gram: A-Z lower-cased, other ASCII than letters and digits a space.
_PLAIN = bytes(b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
#: One pattern a length; the lookarounds make every match begin and end with a word.
_RUNS = [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % i) for i in range(LONGEST)]


def flat(text: str | None) -> bytes:
    """Lower-case words, separated by single spaces."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split())


def bucket_list(words: bytes) -> np.ndarray:
    """Bucket of every run of 1 to LONGEST words of a flat text, repeats included."""
    return np.array([crc32(m[0]) for run in _RUNS for m in run.finditer(words, overlapped=True)],
                    np.int64) % BUCKETS


def _scanned(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id`, `key`, `n_words` and `buckets` (16-bit numbers) of each row."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(2):
                words = flat(text.as_py())
                sizes.append(words.count(b" ") + 1 if words else 0)
                found.append(bucket_list(words).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["id", "key", "n_words", "buckets"])
        release()

    return rows.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, key string, n_words long, buckets binary")


def _totals(scanned: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows: BUCKETS numbers, however many rows there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n += np.bincount(np.frombuffer(x.as_py(), "<u2"), minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                         names=["bucket", "n"])

    total = np.zeros(BUCKETS, np.int64)
    for r in scanned.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed ratio of shares, rounded down."""
    s_all, t_all = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((int(t) + 1) * s_all / ((int(s) + 1) * t_all)))
                     for s, t in zip(source, target)], np.int64)


def _noise(id_: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that the id decides, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame, seed: int = 7, id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text") -> DataFrame:
    """Weight and rank of each document towards the texts of `target`.

    Separators are collapsed to single spaces, and a regular expression that is matched overlapped,
    with lookarounds at both ends, gives the spans of all runs of 1 to LONGEST words; their checksums
    give buckets. A bucket's gain compares its share of `target` with that of all documents; the
    weight is the mean gain of a document's features, and a Gumbel variate of the id turns weights
    into a draw without replacement: the documents of at least LEAST_WORDS words with the SHARE
    percent highest scores have a `rank`.

    Columns: the id, `n_features`, `weight`, `score`, `rank`, and `key` (see `row_key`). Null and
    empty texts have no features, weight 0 and no rank; a null id counts as the empty string; repeated
    rows get a row and a rank each; ties go to the smaller id; an empty table gives no rows, an empty
    target leaves the shares of the documents alone; other columns are not read.
    """
    scanned = store(_scanned(docs, id_col, text_col), "features")
    goal = _scanned(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), "id", "text")
    gain = gains(_totals(scanned), _totals(goal))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weights = [], []
            for x in batch.column(3):
                at = np.frombuffer(x.as_py(), "<u2")
                n.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(weights, pa.int64())],
                names=["id", "key", "n_words", "n_features", "weight"])

    id_type = docs.schema[id_col].dataType.simpleString()
    scored = scanned.mapInArrow(
        weigh, f"id {id_type}, key string, n_words long, n_features long, weight long").select(
        "id", "key", (F.col("n_words") < LEAST_WORDS).alias("short"), "n_features", "weight",
        (F.col("weight") + _noise(F.col("id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("no"))
    scored = store(scored, "scored")
    # Ranges of the order, then places within a range: no task sees more than a range.
    order = [F.asc("short"), F.desc("score"), F.asc("id"), F.asc("no")]
    ranged = store(scored.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"), F.count_if(~F.col("short")).alias("able"))
    sizes = sorted(tuple(r) for r in sizes.collect())  # one row a range
    drawn = SHARE * sum(able for _, _, able in sizes) // 100
    ends = accumulate((n for _, n, _ in sizes), initial=0)
    ahead = docs.sparkSession.createDataFrame(
        [(part, end) for (part, _, _), end in zip(sizes, ends)], "part int, ahead long")
    place = F.row_number().over(W.partitionBy("part").orderBy(*order)) + F.col("ahead")
    return ranged.join(ahead, "part").withColumn("place", place).select(
        F.col("id").alias(id_col), "n_features", "weight", "score",
        F.when(F.col("place") <= drawn, F.col("place")).alias("rank"), "key")


def resample(docs: DataFrame, target: DataFrame, seed: int = 7, id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text") -> DataFrame:
    """The drawn documents, all columns; see `weighted`. Rows of equal id and text stay together."""
    drawn = weighted(docs, target, seed, id_col, text_col, target_text).filter(
        F.col("rank").isNotNull()).select(F.col("key").alias("_drawn")).distinct()
    return docs.join(drawn, row_key(id_col, text_col) == F.col("_drawn"), "left_semi")
