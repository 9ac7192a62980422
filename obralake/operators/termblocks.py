"""Terms of many texts, counted and weighed block by block.

A term's document frequency is known where all its texts are counted, its weight is needed where its text is.
Texts are dealt to blocks; what a block and a group of terms have to tell each other is one row, compressed:
the block's sorted terms one way, their frequencies in the same order the other way. So neither terms nor
weights are shuffled for each text that has them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of texts of a block, and bytes of them as the planner estimates these from the size of files.
BLOCK_TEXTS, BLOCK_BYTES = 4000, 2_000_000
#: Rows of a long table that are summed up at once before they are shuffled; rows given at once.
SUMMED, GIVEN = 1_000_000, 50_000
#: Item texts that meet all products at once, and terms that are multiplied at once.
ITEMS, COLUMNS = 4096, 2048
SLACK = 1e-8
TERM = "struct<term:string,w:double,idf:double,df:bigint>"


def _pieces(texts: pa.Array, stop: Sequence[str]) -> tuple[np.ndarray, pa.Array]:
    """Words and adjacent word pairs of each text, as `text.terms` of `text.tokens`, with the text's place."""
    split = pc.ascii_split_whitespace(texts)
    words, place = split.flatten(), pc.list_parent_indices(split).to_numpy()
    kept = pc.and_(pc.not_equal(words, ""), pc.invert(pc.is_in(words, value_set=pa.array(list(stop), pa.string()))))
    words, place = words.filter(kept), place[kept.to_numpy(zero_copy_only=False)]
    same = place[:-1] == place[1:]
    pairs = pc.binary_join_element_wise(words[:-1].filter(pa.array(same)), words[1:].filter(pa.array(same)), " ")
    return np.concatenate([place, place[:-1][same]]), pa.concat_arrays([words, pairs])


def _counted(texts: pa.Array, stop: Sequence[str], parts: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The block's terms, sorted by the group they are in; for each text and term of it the text's place (in
    order), the term's and how often it comes; where each group ends."""
    place, terms = _pieces(texts, stop)
    names, codes, ends = _grouped(terms, parts)
    both, often = np.unique(place.astype(np.int64) * max(len(names), 1) + codes, return_counts=True)
    return names, both // max(len(names), 1), both % max(len(names), 1), often, ends


def _grouped(terms: pa.Array, parts: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms by group and name, the place of each term among them, and where each group ends."""
    coded = terms.dictionary_encode()
    names = coded.dictionary
    group = pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False) % parts if len(names) else np.zeros(0, int)
    by_name = pc.sort_indices(names).to_numpy()
    order = by_name[np.argsort(group[by_name], kind="stable")]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return names.take(pa.array(order)), rank[coded.indices.to_numpy()], np.searchsorted(group[order], np.arange(parts), "right")


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _packed_terms(terms: pa.Array) -> tuple[int, bytes]:
    """Terms hold no line ends: texts are cut at them."""
    raw = "\n".join(terms.to_pylist()).encode()
    return len(raw), pa.compress(raw, "zstd", asbytes=True)


def _unpacked_terms(size: int, data: bytes) -> pa.Array:
    return pa.array(pa.decompress(data, size, "zstd", asbytes=True).decode().split("\n"), pa.string())


def _rows(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    return [row for b in batches for row in b.to_pylist()]


def _blocks_of(texts: DataFrame, rows: int) -> int:
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, min(parts, rows), -(-rows // BLOCK_TEXTS), min(-(-size // BLOCK_BYTES), rows))


def vectors(texts: DataFrame, rows: int, stop: Sequence[str], asked_only: bool = False) -> DataFrame:
    """Unit TF-IDF vectors of the distinct texts of `texts` (side, n; as many `rows`): side, n, copies, terms.

    Null and empty texts have no `terms`. With `asked_only`, texts of side 0 list only terms that one of side 1
    has; their weights are those of the whole text.
    """
    blocks = _blocks_of(texts, rows)
    groups = -(-blocks // 2)
    # Equal texts meet in their block: one shuffle serves the count of copies and both readings of the block.
    dealt = texts.select("side", "n", F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int").alias("block")).repartition(
        blocks, "block").groupBy("block", "side", "n").agg(F.count("*").alias("copies"))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(list(batches)).combine_chunks()
        if not len(block):
            return
        names, place, code, _, ends = _counted(block["n"].chunk(0), stop, groups)
        side, copies = block["side"].to_numpy()[place], block["copies"].to_numpy()[place]
        df, asked = (np.bincount(code, copies * (side >= s), len(names)).astype(np.int64) for s in (0, 1))
        start = 0
        for group, end in enumerate(ends):
            if end > start:
                size, packed = _packed_terms(names[start:end])
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([group], pa.int32()), "block": pa.array([block["block"][0].as_py()], pa.int32()),
                    "many": pa.array([end - start], pa.int64()), "size": pa.array([size], pa.int64()), "terms": [packed],
                    "df": [_packed(df[start:end])], "asked": [_packed(asked[start:end])]})
            start = end

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _rows(batches)
        if not told:
            return
        coded = pa.concat_arrays([_unpacked_terms(r["size"], r["terms"]) for r in told]).dictionary_encode()
        codes, many = coded.indices.to_numpy(), len(coded.dictionary)
        df, asked = (np.bincount(codes, np.concatenate([_unpacked(r[c], r["many"]) for r in told]), many).astype(np.int64)
                     for c in ("df", "asked"))
        df[asked == 0] *= -1  # no text of side 1 has it
        start = 0
        for r in told:
            end = start + r["many"]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([r["block"]], pa.int32()), "grp": pa.array([r["grp"]], pa.int32()),
                "many": pa.array([r["many"]], pa.int64()), "df": [_packed(df[codes[start:end]])]})
            start = end

    def weigh(block: pa.Table, answers: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        texts = block["n"].chunk(0) if len(block) else pa.array([], pa.string())
        names, place, code, often, _ = _counted(texts, stop, groups)
        told = sorted(answers.to_pylist(), key=lambda r: r["grp"])
        df = np.concatenate([np.zeros(0, np.int64), *[_unpacked(r["df"], r["many"]) for r in told]])
        idf = np.log((1.0 + rows) / (1.0 + np.abs(df))) + 1.0
        raw = (1.0 + np.log(often)) * idf[code]
        w = raw / np.sqrt(np.bincount(place, raw * raw, len(texts)))[place]
        if asked_only:
            kept = (df[code] > 0) | (block["side"].to_numpy()[place] == 1)
            place, code, w = place[kept], code[kept], w[kept]
        listed = pa.StructArray.from_arrays([names.take(pa.array(code)), pa.array(w), pa.array(idf[code]), pa.array(
            np.abs(df[code]))], ["term", "w", "idf", "df"])
        starts = np.searchsorted(place, np.arange(len(texts) + 1)).astype(np.int32)
        return pa.table({"side": block["side"], "n": block["n"], "copies": block["copies"],
                         "terms": pa.ListArray.from_arrays(pa.array(starts), listed)})

    told = dealt.groupBy("block").applyInArrow(
        tell, "grp int, block int, many bigint, size bigint, terms binary, df binary, asked binary")
    answered = told.groupBy("grp").applyInArrow(answer, "block int, grp int, many bigint, df binary")
    weighed = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        weigh, f"side int, n string, copies bigint, terms array<{TERM}>")
    return weighed.withColumn("terms", F.when(F.size("terms") > 0, F.col("terms")))


def strongest(weights: DataFrame, digits: int) -> DataFrame:
    """Of long weights (side, term, idf, w): each side's terms with `n`, how many rows have them, their `idf` and
    the greatest `w`, rounded half up to `digits`."""
    groups = 4 * int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scale = 10.0 ** digits

    def summed(terms: pa.Array, n: np.ndarray, idf: np.ndarray, w: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        names, code, ends = _grouped(terms, groups)
        most, known = np.zeros(len(names), np.int64), np.zeros(len(names))
        np.maximum.at(most, code, w)
        known[code] = idf
        return names, np.bincount(code, n, len(names)).astype(np.int64), known, most, ends

    def told(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for side in pc.unique(rows["side"]).to_pylist():
            own = rows.filter(pc.equal(rows["side"], side)).combine_chunks()
            names, n, idf, w, ends = summed(
                own["term"].chunk(0), np.ones(len(own)), own["idf"].to_numpy(),
                np.floor(own["w"].to_numpy() * scale + 0.5).astype(np.int64))
            start = 0
            for group, end in enumerate(ends):
                if end > start:
                    size, packed = _packed_terms(names[start:end])
                    yield pa.RecordBatch.from_pydict({
                        "grp": pa.array([group], pa.int32()), "side": pa.array([side], pa.int32()),
                        "many": pa.array([end - start], pa.int64()), "size": pa.array([size], pa.int64()), "terms": [packed],
                        **{c: [_packed(x[start:end])] for c, x in (("n", n), ("idf", idf), ("w", w))}})
                start = end

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for b in batches:
            held.append(b)
            many += len(b)
            if many >= SUMMED:
                yield from told(pa.Table.from_batches(held))
                held, many = [], 0
        if many:
            yield from told(pa.Table.from_batches(held))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches)
        if not rows:
            return
        names, n, idf, w, _ = summed(
            pa.concat_arrays([_unpacked_terms(r["size"], r["terms"]) for r in rows]),
            *[np.concatenate([_unpacked(r[c], r["many"], kind) for r in rows]) for c, kind in (
                ("n", np.int64), ("idf", np.float64), ("w", np.int64))])
        for at in range(0, len(names), GIVEN):
            some = slice(at, at + GIVEN)
            yield pa.RecordBatch.from_pydict({
                "side": pa.array(np.full(len(n[some]), rows[0]["side"], np.int32)), "term": names[some],
                "n": pa.array(n[some]), "idf": pa.array(idf[some]), "w": pa.array(w[some] / scale)})

    packed = weights.select("side", "term", "idf", "w").mapInArrow(
        tell, "grp int, side int, many bigint, size bigint, terms binary, n binary, idf binary, w binary")
    return packed.groupBy("grp", "side").applyInArrow(gather, "side int, term string, n bigint, idf double, w double")


def best_pairs(vectors: DataFrame, k: int) -> DataFrame:
    """Pairs of a product and an item text (sid, iid, cosine above zero, copies) that hold the k best items of each
    product, copies counted: of each block of items those that may be among them. For few products: a block
    meets all of them, as a product of matrices."""
    texts = vectors.filter("terms is not null").select(
        "side", "doc", "copies", F.transform("terms", lambda t: t["term"]).alias("terms"),
        F.transform("terms", lambda t: t["w"]).alias("w"))
    items, products = texts.filter("side = 0"), texts.filter("side = 1")
    blocks = max(1, -(-items.count() // ITEMS))
    items = items.select(F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int").alias("block"), "doc", "copies", "terms", "w")
    products = products.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "doc", "terms", "w")

    def compare(offered: pa.Table, asking: pa.Table) -> pa.Table:
        offered, asking = offered.combine_chunks(), asking.combine_chunks()
        cosine = _products(asking, offered)
        copies = offered["copies"].to_numpy()
        if cosine.size:
            down = np.argsort(-cosine, axis=1)
            # The cosine of the k-th best item, or the least one where there are fewer.
            last = np.minimum((np.cumsum(copies[down], axis=1) < k).sum(1), cosine.shape[1] - 1)
            row = np.arange(len(cosine))
            x, y = np.nonzero((cosine >= cosine[row, down[row, last]][:, None] - SLACK) & (cosine > 0))
        else:
            x = y = np.zeros(0, np.int64)
        return pa.table({"sid": asking["doc"].take(pa.array(x)), "iid": offered["doc"].take(pa.array(y)),
                         "cosine": pa.array(cosine[x, y]), "copies": pa.array(copies[y])})

    return items.groupBy("block").cogroup(products.groupBy("block")).applyInArrow(
        compare, "sid binary, iid binary, cosine double, copies bigint")


def _products(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Inner product of each vector of the left with each of the right."""
    out = np.zeros((len(left), len(right)))
    if not out.size:
        return out
    sides = [(t["terms"].chunk(0), t["w"].chunk(0).flatten().to_numpy()) for t in (left, right)]
    codes = pa.concat_arrays([terms.flatten() for terms, _ in sides]).dictionary_encode().indices.to_numpy()
    codes = np.split(codes, [len(sides[0][1])])
    shared = np.intersect1d(*codes)
    entries = [(pc.list_parent_indices(terms).to_numpy(), code, w) for (terms, w), code in zip(sides, codes)]
    for at in range(0, len(shared), COLUMNS):
        some = shared[at:at + COLUMNS]
        has = []
        for (row, code, w), n in zip(entries, out.shape):
            column = np.minimum(np.searchsorted(some, code), len(some) - 1)
            met = some[column] == code
            matrix = np.zeros((n, len(some)))
            matrix[row[met], column[met]] = w[met]
            has.append(matrix)
        out += has[0] @ has[1].T
    return out
