"""Documents linked by Jaccard similarity of word n-grams: size-aware heavy-light join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, store
from .components import components
from .keys import row_key
from .tasks import release, vocabulary

#: Shingles counted by one task, documents whose answers one task gathers, words a worker keeps.
BUCKET, BLOCK, KEPT_WORDS = 500_000, 256, 150_000
#: Elements of an enumerated subset; members compared by one task with as many others.
SUBSET, UNIT = 2, 512
#: Most bits of the filter of sets that may have a link.
FILTER_BITS = 1 << 26
#: Percent of a set's elements that its first ones have in common with those of a linked set.
COMMON = 10

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = value
        return value


def shingle_set(text: str | None, size: int, words: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct `size`-word shingles; ASCII case and space only."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    runs = max(1, len(h) - size + 1)
    mixed = np.full(runs, min(len(h), size), np.uint64)
    for i in range(min(len(h), size)):
        mixed = (mixed ^ h[i:i + runs]) * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * _MIX[1])


def required(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set with any set it links with."""
    return -(-sizes * percent // 100)


def in_common(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Elements that sets of these sizes have in common, with any they link with, within their first ones:
    the least elements of any order, `sizes - required + in_common` of them. A linked set may be smaller;
    the lesser number of the two holds."""
    return np.maximum(1, np.minimum(required(sizes, percent), sizes * COMMON // 100))


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _shipped(docs: DataFrame, shingle: int, buckets: int, id_col: str, text_col: str, choose) -> DataFrame:
    """One row per document (`no` and what follows), and one for each block of documents and bucket with
    the elements that `choose(set, digest)` says, packed: `own` (place in the block) and `hashes`.

    `choose` gives None for a document that has no part in it, not even a row. Ids travel as text.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary("shingle words", _Words)
        no = TaskContext.get().partitionId() << 32
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK):
                part = pdf.iloc[at:at + BLOCK]
                sets = [shingle_set(t, shingle, words) for t in part[text_col]]
                digests = [_digest(s) for s in sets]
                chosen = [choose(s, d) for s, d in zip(sets, digests)]
                taken = [i for i, c in enumerate(chosen) if c is not None]
                block, no = no, no + len(sets)
                if not taken:
                    continue
                nos = block + np.array(taken)
                yield pd.DataFrame({
                    "bucket": nos % buckets, "block": block, "no": nos,
                    "id": part[id_col].to_numpy()[taken], "n": [len(sets[i]) for i in taken],
                    "digest": [digests[i] for i in taken]})
                every = np.concatenate([chosen[i] for i in taken])
                own = np.repeat(np.array(taken, np.uint8), [len(chosen[i]) for i in taken])  # BLOCK is at most 256
                bucket = (every >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                every, own, bucket = every[order], own[order], bucket[order]
                first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(every) else []
                cuts = list(zip(first, [*first[1:], len(every)]))
                yield pd.DataFrame({
                    "bucket": [int(bucket[a]) for a, _ in cuts], "block": block,
                    "own": [own[a:b].tobytes() for a, b in cuts],
                    "hashes": [every[a:b].tobytes() for a, b in cuts]})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in read(batches):
            pdf = pdf.reindex(columns=["bucket", "block", "no", "id", "n", "digest", "own", "hashes"])
            yield pdf.assign(id=_texts(pdf["id"]))
        release()

    return docs.select(F.col(id_col).cast("string").alias(id_col), text_col).mapInPandas(
        rows, "bucket long, block long, no long, id string, n long, digest binary, own binary, hashes binary")


def _texts(column: pd.Series) -> pd.Series:
    """Texts and nulls as objects, however the frame was put together."""
    return pd.Series([x if isinstance(x, str) else None for x in column], column.index, object)


def _times(packed: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Elements of each row of a bucket, and how often each of them is there in all."""
    hashes = [np.frombuffer(x, np.uint64) for x in packed["hashes"]]
    _, inverse, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    return hashes, times[inverse].astype(np.uint32)


def _surveyed(docs: DataFrame, percent: int, shingle: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document, and for each block of documents the places (`own`) of the first elements that
    are first ones elsewhere too.

    In the order of the hashes, linked sets have `in_common` of their first elements in common; only these
    are shipped.
    """
    def first(elements: np.ndarray, _digest: bytes) -> np.ndarray:
        n = np.array(len(elements))
        return elements[:int(n - required(n, percent) + in_common(n, percent))]

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, packed = pdf[pdf["no"].notna()], pdf[pdf["no"].isna()]
        out = whole.assign(own=None)
        if len(packed):
            hashes, times = _times(packed)
            found, at = [], 0
            for block, own, values in zip(packed["block"], packed["own"], hashes):
                again = times[at:at + len(values)] > 1
                at += len(values)
                if again.any():
                    found.append((block, np.frombuffer(own, np.uint8)[again].tobytes()))
            if found:
                out = pd.concat([out, pd.DataFrame(found, columns=["block", "own"])])
        return out.assign(id=_texts(out["id"]))[["block", "no", "id", "n", "digest", "own"]]

    return _shipped(docs, shingle, buckets, id_col, text_col, first).groupBy("bucket").applyInPandas(
        count, "block long, no long, id string, n long, digest binary, own binary")


def _filter(surveyed: DataFrame, percent: int) -> tuple[np.ndarray, int]:
    """Bit set of the digests of sets that may have a link; of bounded size, so others may be in it too."""
    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, packed = pdf[pdf["no"].notna()], pdf[pdf["no"].isna()]
        if not len(packed) or not len(whole):
            return pd.DataFrame(columns=["digest"])
        met = np.bincount(np.frombuffer(b"".join(packed["own"]), np.uint8), minlength=BLOCK)
        place = (whole["no"] - whole["block"]).to_numpy(np.int64)
        # The smallest set it can link with has the fewest in common.
        least = in_common(required(whole["n"].to_numpy(np.int64), percent), percent)
        return whole.loc[met[place] >= least, ["digest"]]

    digests = store(surveyed.select("block", "no", "n", "digest", "own").groupBy("block").applyInPandas(
        gather, "digest binary"), "may")
    slot = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    many, bits = digests.count(), 1 << 12
    while bits < FILTER_BITS and bits < 16 * many:
        bits *= 16
    bits = min(bits, FILTER_BITS)
    slot = F.pmod(slot, F.lit(bits))
    found = digests.select(F.floor(slot / 32).alias("word"), F.pmod(slot, F.lit(32)).cast("int").alias("at")).groupBy(
        "word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("set")).toPandas()
    words = np.zeros(bits // 32, np.uint32)
    words[found["word"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)
    return words, bits


def _counted(docs: DataFrame, shingle: int, buckets: int, id_col: str, text_col: str,
             words: np.ndarray, bits: int) -> DataFrame:
    """One row per document of the filter, and for each block of documents the shingles that occur
    elsewhere too."""
    kept = docs.sparkSession.sparkContext.broadcast(words)  # FILTER_BITS at most

    def choose(elements: np.ndarray, digest: bytes) -> np.ndarray | None:
        slot = int.from_bytes(digest[:4], "big") % bits
        return elements if len(elements) and kept.value[slot // 32] >> np.uint32(slot % 32) & 1 else None

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, packed = pdf[pdf["no"].notna()], pdf[pdf["no"].isna()]
        out = whole.assign(times=None)
        if len(packed):
            hashes, times = _times(packed)
            found, at = [], 0
            for block, own, values in zip(packed["block"], packed["own"], hashes):
                t = times[at:at + len(values)]
                at += len(values)
                again = t > 1
                if again.any():
                    found.append((block, np.frombuffer(own, np.uint8)[again].tobytes(),
                                  values[again].tobytes(), t[again].tobytes()))
            if found:
                out = pd.concat([out, pd.DataFrame(found, columns=["block", "own", "hashes", "times"])])
        return out[["block", "no", "n", "digest", "own", "hashes", "times"]]

    return _shipped(docs, shingle, buckets, id_col, text_col, choose).groupBy("bucket").applyInPandas(
        count, "block long, no long, n long, digest binary, own binary, hashes binary, times binary")


def _prefixes(counted: DataFrame, percent: int) -> DataFrame:
    """`node`, `n`, `shared` (elements that other documents hold too, rarest first), `reach`: so many of
    them belong to the prefix in which linked sets have SUBSET elements in common. One row a set."""
    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, packed = pdf[pdf["no"].notna()], pdf[pdf["no"].isna()]
        if not len(packed) or not len(whole):
            return pd.DataFrame(columns=["node", "n", "reach", "shared"])
        own = np.concatenate([np.frombuffer(x, np.uint8) for x in packed["own"]])
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in packed["hashes"]])
        times = np.concatenate([np.frombuffer(x, np.uint32) for x in packed["times"]])
        order = np.lexsort((hashes, times, own))
        own, hashes = own[order], hashes[order]
        out = []
        for no, n, node in zip(whole["no"].astype(np.int64), whole["n"].astype(np.int64), whole["digest"]):
            a, b = np.searchsorted(own, int(no - pdf["block"].iloc[0])), np.searchsorted(
                own, int(no - pdf["block"].iloc[0]), "right")
            alone = n - (b - a)
            reach = min(n, n - int(required(n, percent)) + SUBSET) - alone
            if reach >= SUBSET and required(n, percent) >= SUBSET:
                out.append((node, n, reach, hashes[a:b].view(np.int64)))
        return pd.DataFrame(out, columns=["node", "n", "reach", "shared"])

    # Of equal sets the one read first stands for all, before any elements are moved.
    whole = counted.filter(F.col("no").isNotNull()).groupBy("digest").agg(
        F.min("no").alias("no"), F.min_by("block", "no").alias("block"), F.first("n").alias("n"))
    packed = counted.filter(F.col("no").isNull()).select("block", "own", "hashes", "times")
    return whole.unionByName(packed, allowMissingColumns=True).groupBy("block").applyInPandas(
        gather, "node binary, n long, reach int, shared array<long>")


def _boundary(sets: DataFrame) -> int:
    """Largest `reach` whose subsets are enumerated, the one with the least work.

    A light set costs its subsets, a list its entries; lists are needed only for elements that a heavy
    set holds. What meets is compared in groups either way. Candidates are the powers of two.
    """
    band = F.ceil(F.log2("reach")).cast("int")
    top = sets.select(F.max(band)).first()[0]
    if top is None:
        return 0
    light = {r.band: r.subsets for r in sets.groupBy(band.alias("band")).agg(
        F.sum(F.col("reach").cast("double") * (F.col("reach") - 1) / 2).alias("subsets")).collect()}
    held = sets.select(F.explode(F.slice("shared", 1, F.col("reach"))).alias("key"), band.alias("band")).groupBy(
        "key").agg(*[F.count_if(F.col("band") >= i).cast("double").alias(f"h{i}") for i in range(top + 1)])
    # With bands from i on as heavy: entries of the lists that a heavy set is in.
    work = [F.sum(F.when(F.col(f"h{i}") > 0, F.col("h0")).otherwise(0.0)).alias(f"w{i}") for i in range(top + 1)]
    lists = [*held.agg(*work).first(), 0.0]
    costs = [sum(v for b, v in light.items() if b < i) + lists[i] for i in range(top + 2)]
    best = min(range(top + 2), key=lambda i: costs[i])
    return 0 if best == 0 else 1 << (best - 1)


def _keys(sets: DataFrame, boundary: int) -> DataFrame:
    """(`key`, `node`, `heavy`): pairs of elements of light sets, single elements where a set is heavy."""
    def enumerate_subsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                keys, nodes = [], []
                for node, reach, shared in zip(part["node"], part["reach"], part["shared"]):
                    x = np.sort(np.asarray(shared[:reach], np.int64).view(np.uint64))
                    i, j = np.triu_indices(len(x), 1)
                    mixed = (x[i] * _MIX[2]) ^ (x[j] * _MIX[1])
                    keys.append((mixed ^ (mixed >> np.uint64(31))).view(np.int64))
                    nodes += [node] * len(i)
                yield pd.DataFrame({"key": np.concatenate(keys), "node": nodes, "heavy": 0})

    heavy = F.col("reach") > boundary
    light = sets.filter(~heavy).select("node", "reach", "shared").mapInPandas(
        enumerate_subsets, "key long, node binary, heavy int").withColumn("kind", F.lit(SUBSET))
    lists = sets.select(F.explode(F.slice("shared", 1, F.col("reach"))).alias("key"), "node",
                        heavy.cast("int").alias("heavy"), F.lit(1).alias("kind"))
    if not sets.filter(heavy).head(1):
        return light
    return light.unionByName(lists)


def _compare(percent: int):
    """Links inside a unit: each node's smallest node in reach, and the copies it is linked with."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values("node", ignore_index=True)
        nodes, n, copies = pdf["node"].tolist(), pdf["n"].to_numpy(), pdf["copies"].to_numpy()
        side = pdf["chunk"].to_numpy()
        lone = pdf["a"].iloc[0] == pdf["b"].iloc[0]
        sizes = np.array([len(s) for s in pdf["shared"]])
        value = np.concatenate(pdf["shared"].tolist())
        owner = np.repeat(np.arange(len(pdf)), sizes)
        order = np.argsort(value, kind="stable")
        holders = owner[order]
        start = np.flatnonzero(np.r_[True, np.diff(value[order]) != 0])
        group = np.zeros(len(value), np.int64)
        group[order] = np.cumsum(np.r_[0, np.diff(value[order]) != 0])
        length = np.diff(np.r_[start, len(value)])
        first = np.r_[0, np.cumsum(sizes)]
        root, links = np.arange(len(pdf)), np.zeros(len(pdf), np.int64)
        for i in range(len(pdf)):
            lists = group[first[i]:first[i + 1]]
            lists = lists[length[lists] > 1]
            if not len(lists):
                continue
            many = length[lists]
            at = np.repeat(start[lists] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            both = np.bincount(holders[at], minlength=len(pdf))
            linked = 100 * both >= percent * (n[i] + n - both)
            linked[:i + 1] = False
            if not lone:
                linked &= side != side[i]
            j = np.flatnonzero(linked)
            if len(j):
                links[i] += copies[j].sum()
                links[j] += copies[i]
                met = np.unique(root[np.r_[i, j]])
                root[np.isin(root, met)] = met[0]
        kept = links > 0
        return pd.DataFrame({"node": [x for x, k in zip(nodes, kept) if k],
                             "root": [nodes[r] for r in root[kept]], "links": links[kept]})
    return run


def _linked(sets: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """(`node`, `root`, `links`) rows of the compared units; `grouped` gives each node its group.

    A group of more than UNIT nodes is cut into chunks of similar size sets, and only chunks that can
    hold links are compared with each other.
    """
    # Nodes are dealt to units without their elements, which move twice at the end.
    width = float(np.log(100 / percent) + 1e-6)  # of sizes that links allow, and a little for rounding
    members = store(sets.select("node", "n").join(grouped, "node").withColumn(
        "band", F.floor(F.log("n") / width).cast("int")), "members")
    crowd = members.groupBy("group").agg(F.count("*").alias("crowd")).filter(F.col("crowd") > UNIT)
    members = store(members.join(crowd, "group", "left").withColumn(
        "band", F.when(F.col("crowd").isNull(), -1).otherwise(F.col("band"))).drop("crowd"), "members")
    bands = store(members.groupBy("group", "band").agg(F.when(F.col("band") < 0, 1).otherwise(
        F.ceil(F.count("*") / (UNIT // 2))).cast("int").alias("salts")), "bands")

    def chunk(salt):
        return (F.col("band").cast("long") * 1_000_000_000 + salt).alias("chunk")

    chunks = store(bands.select("group", "band", F.explode(F.sequence(
        F.lit(0), F.col("salts") - 1)).alias("salt")).select("group", "band", chunk(F.col("salt"))), "chunks")
    other = chunks.select("group", F.col("band").alias("band_b"), F.col("chunk").alias("b"))
    near = chunks.withColumnRenamed("chunk", "a").withColumn(
        "band_b", F.explode(F.array("band", F.col("band") + 1)))
    units = near.join(other, ["group", "band_b"]).filter(F.col("a") <= F.col("b")).select("group", "a", "b")
    parts = store(units.select("group", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk"),
                               "a", "b"), "units")
    placed = members.join(bands, ["group", "band"]).select(
        "group", "node", "n", "copies", chunk(F.pmod(F.xxhash64("node"), F.col("salts"))))
    spread = store(placed.join(parts, ["group", "chunk"]), "spread").join(
        sets.select("node", "shared"), "node")
    # Else a join by group would have brought all units of a group into one task.
    return spread.repartition("group", "a", "b").groupBy("group", "a", "b").applyInPandas(
        _compare(percent), "node binary, root binary, links long")


def link_documents(docs: DataFrame, percent: int = 90, shingle: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Class of each document under links of equal or similar shingle sets.

    Two sets link when 100 * intersection >= `percent` * union. Documents with equal sets are one
    node. Linked sets have a share of their first elements in the order of the hashes in common (`in_common`);
    sets that have fewer go no further, and a filter of bounded size says so to a second reading. Shingles of the others are ordered by
    the number of documents that hold them; linked sets have SUBSET elements in common within their
    rarest ones, of which those held by a single document are left out. Light sets meet in their
    enumerated subsets, heavy sets in inverted lists; the boundary is the one with the least work. Sets that meet form groups, and all sets of a group are compared
    exactly, in units of bounded size. Groups that meet by chance cost time, not correctness.

    Columns: the id, `n_shingles`, `component_id` (smallest id reachable, itself included), `n_links`
    (other documents linked directly). Null and empty texts, and texts without words, link with
    nothing; repeated rows are copies of each other; null ids never name a class unless all its ids
    are null; an empty table gives no rows; other columns are not read. Shingles are compared by
    64-bit hashes, equal sets by 128-bit digests.
    """
    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(4, -(-volume // (7 * BUCKET)))
    surveyed = store(_surveyed(docs, percent, shingle, buckets, id_col, text_col), "surveyed")
    whole = surveyed.filter(F.col("no").isNotNull()).select(
        F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "n", "digest")
    classes = store(whole.filter(F.col("n") > 0).groupBy("digest").agg(
        F.min("id").alias("least"), F.count("*").alias("copies")), "classes")

    counted = store(_counted(docs, shingle, buckets, id_col, text_col, *_filter(surveyed, percent)), "counted")
    sets = store(_prefixes(counted, percent), "sets")
    drop_stored(counted)
    keys = store(_keys(sets, _boundary(sets)), "keys")
    leads = store(keys.groupBy("kind", "key").agg(
        F.min("node").alias("lead"), F.count("*").alias("many"), F.max("heavy").alias("heavy")).filter(
        (F.col("many") > 1) & ((F.col("kind") > 1) | (F.col("heavy") > 0))).select(
        "kind", "key", "lead"), "leads")
    met = keys.select("kind", "key", "node").join(leads, ["kind", "key"]).select(
        F.col("node").alias("a"), F.col("lead").alias("b"))
    grouped = components(met).withColumnRenamed("root", "group")
    copies = classes.select(F.col("digest").alias("node"), "copies")
    found = store(_linked(sets, grouped.join(copies, "node"), percent), "links")
    drop_stored(keys, leads, sets)

    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = store(classes.join(roots, classes["digest"] == F.col("node"), "left").select(
        "digest", "least", "copies", F.coalesce("root", "digest").alias("root")), "named")
    least = store(named.groupBy("root").agg(F.min("least").alias("component")), "least")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    answer = store(named.join(least, "root").join(links, named["digest"] == links["node"], "left").select(
        "digest", "component",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "answer")
    return whole.join(answer, "digest", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"))


def keep_one_of_each(docs: DataFrame, percent: int = 90, shingle: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The documents, all columns, with the smallest id of their class; of repeated rows one.

    Rows are told apart by id and text, so one of two texts under an id may go. Null ids come last: a
    class of rows without an id keeps one of them. Documents without words are no copies and stay.
    """
    key, text = row_key(id_col, text_col), F.col(f"`{text_col}`")
    found = store(link_documents(docs.select(key.alias("_key"), text.alias("_text")), percent, shingle,
                                 "_key", "_text").filter("n_shingles > 0"), "copies")
    named = F.regexp_replace("_key", ":[0-9A-F]*$", "")
    id_ = F.when(named != "~", named).try_cast(docs.schema[id_col].dataType)
    first = found.groupBy("component_id").agg(F.min(F.struct(
        id_.isNull().alias("none"), id_.alias("id"), F.col("_key").alias("key"))).alias("first"), F.count("*").alias("rows"))
    first = store(first.filter("rows > 1").select("component_id", F.col("first.key").alias("_first")), "firsts")
    # Stored, so that its size is known before whole texts would be shuffled to meet it.
    gone = store(found.join(first, "component_id").filter(F.col("_key") != F.col("_first")).select(
        F.col("_key").alias("_gone")).distinct(), "gone")
    kept = docs.join(gone, key == F.col("_gone"), "left_anti")
    again = store(found.join(first, found["_key"] == first["_first"], "left_semi").groupBy(
        F.col("_key").alias("_again")).count().filter("count > 1").select("_again"), "repeated")
    if not again.head(1):
        return kept
    repeated = kept.join(again, key == F.col("_again"), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, key == F.col("_again"), "left_anti").unionByName(repeated)
