"""Secrets in texts, told apart by how many owners have them (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import store
from .keys import row_key

# The forms of secrets, in the order in which kinds are listed. Runs are maximal, so a
# least length inside the pattern finds the same as one that is asked for afterwards; not so for the
# values of assignments, which are filtered.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = "(AKIA[A-Z0-9]{16,})"
HEX = "([0-9a-f]{24,})"
KINDS = ("assign", "access", "hex", "live")
LEAST_VALUE = 6
#: Owners from which on a value counts as a widely copied example; the least length and number of
#: different characters of a value that looks live.
COPIED_OWNERS, LIVE_LENGTH, LIVE_CHARACTERS = 3, 16, 8
PLACEHOLDER = "(?i)example|sample|changeme|dummy|placeholder|your[_-]|xxxx|1234567890"

_OPEN, _CUT, _OTHER = "\u0001", "\u0002", "\u0003"


def candidates(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """Pieces of texts that hold a match of some kind, in order: `kind`, `i`, `before`, `value`, `after`.

    Piece 0 is what stands before the first match; each other one is a match (`before`, the lead of an
    assignment, and `value`) with what follows it. Texts are cut by marks put around the matches.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.when(text.rlike(f"[{_OPEN}{_CUT}]"),
                  F.translate(text, _OPEN + _CUT, _OTHER * 2)).otherwise(text)

    def cut(kind: int, pattern: str, to: str) -> Column:
        marked = F.regexp_replace("_t", pattern, to)
        return F.struct(F.lit(kind).alias("kind"), F.split(marked, _OPEN).alias("pieces"))

    cuts = F.array(cut(0, ASSIGN, f"{_OPEN}$1{_CUT}$2{_CUT}"), cut(1, ACCESS, f"{_OPEN}{_CUT}$1{_CUT}"),
                   cut(2, HEX, f"{_OPEN}{_CUT}$1{_CUT}"))
    # The marked texts are made once, before the cuts are spread.
    rows = docs.select(*more, text.alias("_t"))
    kept = [c for c in rows.columns if c != "_t"]
    spread = rows.select(*kept, F.explode(cuts).alias("c")).filter(F.size("c.pieces") > 1).select(
        *kept, "c.kind", F.posexplode("c.pieces").alias("i", "piece"))
    parts = F.split("piece", _CUT)
    return spread.select(
        *kept, "kind", "i", F.length(F.when(F.col("i") > 0, parts[0]).otherwise("")).alias("before"),
        F.when(F.col("i") > 0, parts[1]).alias("value"),
        F.length(F.when(F.col("i") > 0, parts[2]).otherwise(F.col("piece"))).alias("after"))


def ownership(found: DataFrame) -> DataFrame:
    """`hash`, `owners`, `repositories` and `class` of each value of `found` (`value`, `owner`, `repo`).

    A value of COPIED_OWNERS owners or more, or with the words of a placeholder, is `copied`; another
    one that is long and varied is `live`; the rest is `unclear`.
    """
    seen = found.groupBy(F.sha2("value", 256).alias("hash"), "owner", "repo").agg(
        F.min("value").alias("value"))
    counted = seen.groupBy("hash").agg(
        F.countDistinct(F.coalesce("owner", F.lit(""))).alias("owners"),
        F.countDistinct(F.coalesce("repo", F.lit(""))).alias("repositories"),
        F.min("value").alias("value"))
    varied = (F.length("value") >= LIVE_LENGTH) & (
        F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARACTERS)
    return counted.select("hash", "owners", "repositories", F.when(
        (F.col("owners") >= COPIED_OWNERS) | F.col("value").rlike(PLACEHOLDER), "copied").when(
        varied, "live").otherwise("unclear").alias("class"))


def scan_secrets(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The id and `secrets` of each document: structs of start, kind number, end and the value's class.

    Assignments, access keys and long hexadecimal runs are found per kind, leftmost and without
    overlap; offsets are code points. Equal values are brought together over all documents by a hash
    and counted by distinct owners and repositories; a value that looks live gets a span of its own
    (kind `live`) beside that of its match. Null and empty texts hold none; repeated rows get equal
    results and count once an owner; an owner or repository that is null counts as one; an empty
    table gives no rows; other columns are not read.
    """
    pieces = store(candidates(docs, text_col, row_key(id_col, text_col).alias("key"),
                              owner.alias("owner"), repo.alias("repo")), "pieces")
    valid = (F.col("i") > 0) & ((F.col("kind") > 0) | (F.length("value") >= LEAST_VALUE))
    classes = store(ownership(pieces.filter(valid)), "owners")
    order = W.partitionBy("key", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    length = F.col("before") + F.coalesce(F.length("value"), F.lit(0)) + F.col("after")
    placed = pieces.drop("owner", "repo").dropDuplicates(["key", "kind", "i"]).withColumn(
        "start", F.coalesce(F.sum(length).over(order), F.lit(0))).filter(valid).select(
        "key", "kind", "start", "before", F.sha2("value", 256).alias("hash"),
        (F.col("start") + F.col("before") + F.length("value")).alias("end"))
    placed = store(placed, "placed").join(classes, "hash")
    span = lambda start, kind: F.struct(start.alias("start"), kind.alias("kind"), "end", "class")
    own = span(F.col("start"), F.col("kind"))
    live = F.when(F.col("class") == "live", span(F.col("start") + F.col("before"), F.lit(3)))
    spans = placed.select("key", F.explode(F.array_compact(F.array(own, live))).alias("s"))
    per_text = spans.groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("secrets"))
    none = F.array().cast(per_text.schema["secrets"].dataType)
    return docs.select(F.col(id_col), row_key(id_col, text_col).alias("key")).join(
        per_text, "key", "left").select(id_col, F.coalesce("secrets", none).alias("secrets"))


def spans_text(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
