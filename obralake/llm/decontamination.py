"""Benchmark windows in documents, by a prefix-filtered join of word shingles (DataFrame only)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import store
from .keys import row_key

#: Words of a shingle, and the most benchmark shingles that are sent to every executor.
SHINGLE, SENT = 3, 1_000_000
# Fixed value: all ASCII characters but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text_col: str) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters; empty for null."""
    return F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS), "")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; `lower` does just that where there is nothing but ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def shingles(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """`pos` and `shingle` of every run of as many words as each of `lengths` says; drops `w`."""
    n = max([1, *lengths])
    shifted = [F.col("w") if i == 0 else F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1)))
               for i in range(n)]
    zipped = F.arrays_zip(*[s.alias(f"w{i}") for i, s in enumerate(shifted)])
    kept = [c for c in rows.columns if c != "w"]
    at = rows.select(*kept, F.posexplode(zipped).alias("pos", "z"))
    runs = [F.when(F.col(f"z.w{k - 1}").isNotNull(),
                   lower_ascii(F.concat_ws(" ", *[F.col(f"z.w{i}") for i in range(k)])))
            for k in lengths]
    if len(runs) == 1:
        at = at.select(*kept, "pos", runs[0].alias("shingle"))
    else:
        at = at.select(*kept, "pos", F.explode(F.array(*runs)).alias("shingle"))
    return at.filter(F.col("shingle").isNotNull())


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Maximal stretches of document words covered by windows of an item.

    Columns: `key` (see `row_key`), `item` (the item's id as string), `first` and `last` (word
    positions, `last` exclusive). A window is `window` consecutive words of an item; an item of fewer
    words, but not none, is one window.

    Shingles of a window are ordered by their number of occurrences in the documents. A document that
    holds a window holds its rarest shingle, so only those are joined; the place of the shingle gives
    the alignment, which must leave room for the window in the document. An alignment is verified by
    the item's other shingles at their places.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        words(item_text).alias("w")).filter(F.size("w") > 0).select(
        "item", "w", F.size("w").alias("m")).withColumn(
        "k", F.least(F.col("m"), F.lit(SHINGLE))).withColumn(
        "length", F.least(F.col("m"), F.lit(window)))
    lengths = sorted(r.k for r in items.select("k").distinct().collect())
    # Equal texts of one item count once; a text keeps its number because it is stored.
    items = store(items.distinct().withColumn("text_no", F.monotonically_increasing_id()), "items")
    parts = store(shingles(items, lengths).filter(
        F.size(F.split("shingle", " ")) == F.col("k")).withColumnRenamed("pos", "off"), "parts")
    named = parts.select("shingle").distinct().withColumn("sid", F.monotonically_increasing_id())
    named = store(named, "shingles")
    parts = parts.join(named, "shingle").drop("shingle")
    if named.count() <= SENT:
        named = F.broadcast(named)

    found = docs.select(row_key(id_col, text_col).alias("key"), words(text_col).alias("w")).withColumn(
        "n", F.size("w"))
    found = store(shingles(found, lengths).join(named, "shingle").select("key", "n", "pos", "sid"),
                  "found")
    counts = found.groupBy("sid").agg(F.count("*").alias("times"))

    need = F.col("length") - F.col("k")
    start = F.explode(F.sequence(F.greatest(F.lit(0), F.col("off") - need),
                                 F.least(F.col("off"), F.col("m") - F.col("length"))))
    inside = parts.join(counts, "sid", "left").select(
        "text_no", "length", start.alias("start"), "off", "sid",
        F.coalesce("times", F.lit(0)).alias("times"))
    rarest = inside.groupBy("text_no", "start").agg(
        F.min(F.struct("times", "off", "sid", "length")).alias("r")).filter(F.col("r.times") > 0)
    prefix = rarest.groupBy("text_no", "r.off", "r.sid", "r.length").agg(
        F.min("start").alias("start_min"), F.max("start").alias("start_max"))

    shift = F.col("pos") - F.col("off")
    aligned = found.join(prefix, "sid").filter(
        (F.col("n") >= F.col("length")) & (shift + F.col("start_max") >= 0)
        & (shift + F.col("start_min") + F.col("length") <= F.col("n"))).select(
        "key", "n", "text_no", shift.alias("shift")).distinct()
    wanted = aligned.join(parts, "text_no").withColumn("pos", F.col("shift") + F.col("off")).filter(
        (F.col("pos") >= 0) & (F.col("pos") + F.col("k") <= F.col("n")))
    held = wanted.join(found.select("key", "pos", "sid").distinct(), ["key", "pos", "sid"])
    run = F.col("off") - F.row_number().over(W.partitionBy("key", "text_no", "shift").orderBy("off"))
    return held.withColumn("run", run).groupBy(
        "key", "item", "text_no", "shift", "length", "k", "run").agg(
        F.min("off").alias("a"), F.max("off").alias("b")).filter(
        F.col("b") - F.col("a") >= need).select(
        "key", "item", (F.col("shift") + F.col("a")).alias("first"),
        (F.col("shift") + F.col("b") + F.col("k")).alias("last"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """For each document: `n_words`, `n_hit` (words inside a window), `items` and `contaminated`.

    Null and empty texts have no words and no hits; repeated rows get a row each; empty tables give
    no hits; an item without an id reports as the empty string; other columns are not read.
    """
    stretches = occurrences(docs, benchmark, window, id_col, text_col)
    before = F.max("last").over(W.partitionBy("key").orderBy("first", "last").rowsBetween(
        W.unboundedPreceding, -1))
    fresh = F.col("last") - F.greatest("first", F.coalesce(before, F.lit(0)))
    hits = store(stretches.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("key").agg(
        F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items")), "hits")
    base = docs.select(F.col(id_col), row_key(id_col, text_col).alias("key"),
                       F.size(words(text_col)).cast("long").alias("n_words"))
    empty = F.array().cast("array<string>")
    return base.join(hits, "key", "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", empty).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The documents, all columns, that hold no window of the benchmark."""
    leaks = store(occurrences(docs, benchmark, window, id_col, text_col).select(
        F.col("key").alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, row_key(id_col, text_col) == F.col("_leak"), "left_anti")
