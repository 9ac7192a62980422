"""The searches that the description columns serve: one phrase by a scan, tables of phrases by joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import store

#: Texts of a token or trigram that share a join key.
SPREAD = 50_000
#: Texts of either side in a block of texts that are compared pair by pair.
BLOCK = 2000
#: Trigrams that are compared at once.
COLUMNS = 4096
#: Keys of equal texts that go together, pairs of texts that are given at once.
KEYS, PAIRS = 256, 4096
SLACK = 1e-9


def token_search(df: DataFrame, query: str, tokens: str = "descricao_fts") -> DataFrame:
    """Rows that hold every token of the query, with the number of query tokens matched."""
    wanted = T.search_tokens(T.unaccent(F.lower(F.lit(query))))
    hits = F.size(F.array_intersect(F.col(tokens), wanted))
    return df.withColumn("acertos", hits).filter(F.col("acertos") == F.size(wanted))


def trigram_similarity(left: Column, right: Column) -> Column:
    common = F.size(F.array_intersect(left, right))
    return common / F.nullif(F.size(left) + F.size(right) - common, F.lit(0))


def trigram_search(df: DataFrame, phrase: str, text: str = "descricao_norm",
                   threshold: float = 0.3) -> DataFrame:
    """Rows whose text resembles the phrase; a scan, no join."""
    mine = T.trigrams(F.col(text))
    asked = T.trigrams(T.unaccent(F.lower(F.lit(phrase))))
    return df.withColumn("semelhanca", trigram_similarity(mine, asked)).filter(
        F.col("semelhanca") >= threshold)


def _spread(asked: DataFrame, offered: DataFrame, token: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a `part`: the texts of a frequent token are dealt to several keys."""
    hot = offered.groupBy(token).agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    return (asked.join(hot, token, "left").withColumn("part", F.explode(F.sequence(
                F.lit(0), parts - 1))).drop("parts"),
            offered.join(hot, token, "left").withColumn("part", F.pmod(
                F.xxhash64("text_id"), parts).cast("int")).drop("parts"))


def _texts(df: DataFrame, text: str, by: Sequence[str], split) -> DataFrame:
    """Each text once for each value of `by`, with a digest, its distinct `parts` and their number."""
    folded = T.unaccent(F.lower(F.col(text)))
    key = F.unhex(F.md5(F.to_json(F.struct(*by, folded.alias("_t")))))
    return df.select(*by, folded.alias("_t"), key.alias("text_id")).filter(
        F.col("_t").isNotNull()).dropDuplicates(["text_id"]).select(
        *by, "text_id", split(F.col("_t")).alias("parts")).withColumn("n", F.size("parts")).filter("n > 0")


def _keyed(df: DataFrame, text: str, by: Sequence[str], key: str) -> DataFrame:
    folded = T.unaccent(F.lower(F.col(text)))
    return df.filter(F.col(text).isNotNull()).select(
        key, F.unhex(F.md5(F.to_json(F.struct(*by, folded.alias("_t"))))).alias("text_id"))


def _listed(df: DataFrame, text: str, by: Sequence[str], split, key: str) -> DataFrame:
    """As `_texts`, with the `keys` of each text; those of a text with many of them are dealt to several rows,
    numbered by `chunk`."""
    folded = T.unaccent(F.lower(F.col(text)))
    text_id = F.unhex(F.md5(F.to_json(F.struct(*by, folded.alias("_t")))))
    rows = df.select(*by, folded.alias("_t"), text_id.alias("text_id"), F.struct(F.col(key).alias("key")).alias("_key")).filter(
        F.col("_t").isNotNull())
    hot = rows.groupBy("text_id").agg(F.ceil(F.count("*") / KEYS).cast("int").alias("_chunks")).filter("_chunks > 1")
    dealt = F.pmod(F.xxhash64("_key"), F.coalesce("_chunks", F.lit(1))).cast("int")
    texts = rows.join(hot, "text_id", "left").groupBy("text_id", dealt.alias("chunk")).agg(
        *[F.first(c).alias(c) for c in by], F.first("_t").alias("_t"), F.collect_list("_key").alias("keys"))
    # Of a text whose keys fall into few chunks, the first one has the number 0 all the same.
    first = Window.partitionBy("text_id").orderBy("chunk")
    return texts.withColumn("chunk", F.row_number().over(first) - 1).select(
        *by, "text_id", "chunk", "keys", split(F.col("_t")).alias("parts")).withColumn("n", F.size("parts")).filter("n > 0")


def _blocks(left: DataFrame, right: DataFrame, by: Sequence[str], threshold: float) -> DataFrame:
    """Alike texts from blocks of both sides with equal `by`, each pair compared once. Keys travel with their
    text, so that no pair has to."""
    place = lambda g, i: F.ascii(F.substring(g, i, 1)).cast("bigint")
    code = F.transform("parts", lambda g: (place(g, 1) * 2 ** 21 + place(g, 2)) * 2 ** 21 + place(g, 3))
    left, right = (df.select(*by, F.lit(0).alias("_all"), "side", "text_id", "chunk", "keys", code.alias("codes"))
                   for df in (left, right))
    by = [*by, "_all"]
    many = F.ceil(F.count("*") / BLOCK).cast("int")
    sizes = left.groupBy(*by).agg(many.alias("p")).join(right.groupBy(*by).agg(many.alias("q")), by)
    mine = lambda parts: F.pmod(F.xxhash64("text_id", "chunk"), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    asked = left.join(sizes, by).select(*by, mine("p").alias("i"), each("q").alias("j"), "side", "codes", F.col(
        "keys").alias("asked"), F.lit(None).cast(right.schema["keys"].dataType).alias("offered"))
    offered = right.join(sizes, by).select(*by, each("p").alias("i"), mine("q").alias("j"), "side", "codes", F.lit(
        None).cast(left.schema["keys"].dataType).alias("asked"), F.col("keys").alias("offered"))
    kept = ["side", "codes", "asked", "offered"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches([b.select(kept) for b in batches]).combine_chunks()
        mine, theirs = (block.filter(pc.equal(block["side"], side)).combine_chunks() for side in (1, 0))
        if not len(mine) or not len(theirs):
            return
        codes = [[row.values.to_numpy() for row in side["codes"]] for side in (mine, theirs)]
        common = _common_counts(*codes)
        a, b = (np.array([len(c) for c in side]) for side in codes)
        alike = common / (a[:, None] + b[None, :] - common)
        x, y = np.nonzero(alike >= threshold)
        score = alike[x, y]
        best = np.lexsort((-score, x))
        x, y, score = x[best], y[best], score[best]
        keys = mine["asked"].chunk(0), theirs["offered"].chunk(0)
        for at in range(0, len(x), PAIRS):
            some = slice(at, at + PAIRS)
            yield pa.RecordBatch.from_arrays(
                [keys[0].take(pa.array(x[some])), keys[1].take(pa.array(y[some])), pa.array(score[some])],
                ["asked", "offered", "semelhanca"])

    types = [df.schema["keys"].dataType.simpleString() for df in (left, right)]
    return asked.unionByName(offered).groupBy(*by, "i", "j").applyInArrow(
        compare, f"asked {types[0]}, offered {types[1]}, semelhanca double")


def _common_counts(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """How many codes each text of the left has in common with each of the right; codes are distinct in a text."""
    out = np.zeros((len(left), len(right)))
    if not len(left) or not len(right):
        return out
    sides = [(np.repeat(np.arange(len(s)), [len(c) for c in s]), np.concatenate(s)) for s in (left, right)]
    shared = np.intersect1d(sides[0][1], sides[1][1])
    for at in range(0, len(shared), COLUMNS):
        some = shared[at:at + COLUMNS]
        has = []
        for (row, codes), n in zip(sides, out.shape):
            column = np.minimum(np.searchsorted(some, codes), len(some) - 1)
            met = some[column] == codes
            bits = np.zeros((n, len(some)), np.float32)
            bits[row[met], column[met]] = 1
            has.append(bits)
        out += has[0] @ has[1].T
    return out


def _meetings(prefixes: DataFrame, left: DataFrame, right: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """How often texts meet in a trigram of their prefixes, and how many pairs of texts there are at all."""
    count = lambda side: F.count_if(F.col("side") == side).cast("double")
    met = prefixes.groupBy(*by, "gram").agg((count(1) * count(0)).alias("m"))
    texts = left.select("side", *by).unionByName(right.select("side", *by)).groupBy(*by).agg(
        (count(1) * count(0)).alias("m"))
    for name in by:
        met, texts = met.filter(F.col(name).isNotNull()), texts.filter(F.col(name).isNotNull())
    return tuple(df.agg(F.coalesce(F.sum("m"), F.lit(0.0))).first()[0] for df in (met, texts))


def _by_prefix(prefixes: DataFrame, left: DataFrame, right: DataFrame, by: Sequence[str],
               threshold: float) -> DataFrame:
    """Alike texts among those that have a trigram of their prefixes in common."""
    asked, offered = _spread(prefixes.filter("side = 1").drop("side"),
                             prefixes.filter("side = 0").drop("side"), "gram")
    asked = asked.withColumnsRenamed({"text_id": "phrase_id", "n": "a", "place": "i"})
    offered = offered.withColumnsRenamed({"n": "b", "place": "j"})
    need = F.ceil((F.col("a") + F.col("b")) * threshold / (1 + threshold) - SLACK)
    met = asked.join(offered, [*by, "gram", "part"]).filter(
        (F.least("a", "b") >= threshold * F.greatest("a", "b") - SLACK)).groupBy("phrase_id", "text_id").agg(
        F.count("*").alias("common"), F.max("i").alias("i"), F.max("j").alias("j"),
        F.first("a").alias("a"), F.first("b").alias("b"))
    room = F.col("common") + F.least(F.col("a") - F.col("i"), F.col("b") - F.col("j")) - 1
    pairs = met.filter(room >= need).select("phrase_id", "text_id")
    alike = trigram_similarity(F.col("mine"), F.col("parts"))
    return pairs.join(left.select(F.col("text_id").alias("phrase_id"), F.col("parts").alias("mine"), F.col("keys").alias(
        "asked")), "phrase_id").join(right.select("text_id", "parts", F.col("keys").alias("offered")), "text_id").select(
        "asked", "offered", alike.alias("semelhanca")).filter(F.col("semelhanca") >= threshold)


def trigram_join(phrases: DataFrame, items: DataFrame, phrase_key: str, item_key: str,
                 phrase: str = "frase", text: str = "descricao", by: Sequence[str] = (),
                 threshold: float = 0.3) -> DataFrame:
    """Pairs of a phrase and an item whose texts resemble each other: both keys and `semelhanca`.

    Similarity is that of the trigram sets, as in `trigram_search`; `by` columns must be equal. Trigrams
    are ordered by rarity, and two texts as similar as asked have one in common in their prefixes. A
    pair that meets there is kept only while its lengths and the places of the last common trigram leave
    room for enough of them; what is left is compared whole. Where texts would meet more often than there
    are pairs, blocks of texts are compared pair by pair instead. Equal texts are compared once for all their
    keys, up to KEYS of them. Texts that are null or have no letter or digit match nothing; repeated keys give a
    row each.
    """
    left = store(_listed(phrases, phrase, by, T.trigrams, phrase_key).withColumn("side", F.lit(1)), "phrases")
    right = store(_listed(items, text, by, T.trigrams, item_key).withColumn("side", F.lit(0)), "texts")
    every = left.filter("chunk = 0").drop("keys").unionByName(right.filter("chunk = 0").drop("keys")).select("side", *by, "text_id", "n", F.explode("parts").alias("gram"))
    often = store(every.groupBy("gram").agg(F.count("*").alias("often")), "grams")
    ordered = every.join(often, "gram").groupBy("side", *by, "text_id", "n").agg(
        F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("grams"))
    least = F.ceil(F.col("n") * threshold - SLACK)
    prefixes = store(ordered.select("side", *by, "text_id", "n", F.posexplode(
        F.slice("grams", 1, (F.col("n") - least + 1).cast("int"))).alias("place", "g")).select(
        "side", *by, "text_id", "n", "place", "g.gram"), "prefixes")
    met, pairs = _meetings(prefixes, left.filter("chunk = 0"), right.filter("chunk = 0"), by)
    found = _blocks(left, right, by, threshold) if met > pairs and threshold > 0 else _by_prefix(prefixes, left, right, by, threshold)
    return found.select(F.explode("asked").alias("_asked"), "offered", "semelhanca").select(
        F.col("_asked.key").alias(phrase_key), F.explode("offered").alias("_offered"), "semelhanca").select(
        phrase_key, F.col("_offered.key").alias(item_key), "semelhanca")


def token_search_join(queries: DataFrame, docs: DataFrame, query_key: str, doc_key: str, k: int = 10,
                      query: str = "consulta", text: str = "descricao", by: Sequence[str] = ()) -> DataFrame:
    """The `k` best texts that hold every token of each query: both keys, `peso` and `posto`.

    `peso` is the share of a text's distinct tokens that the query asks for; ties go to the smaller key.
    Texts are found by the query's rarest token, and the others are looked up by text and token. Equal
    texts are searched once. A query without tokens, or with one that no text holds, finds nothing.
    """
    asked = store(_texts(queries, query, by, T.search_tokens), "queries")
    # Of the texts' tokens only those that a query has are ever looked up.
    wanted = store(asked.select(*by, F.explode("parts").alias("token")).distinct(), "wanted")
    postings = store(_texts(docs, text, by, T.search_tokens).select(
        *by, "text_id", "n", F.explode("parts").alias("token")).join(wanted, [*by, "token"], "left_semi"), "postings")
    often = store(postings.groupBy(*by, "token").agg(F.count("*").alias("often")), "tokens")
    wanted = asked.select(*by, F.col("text_id").alias("query_id"), F.col("n").alias("many"),
                          F.explode("parts").alias("token")).join(often, [*by, "token"])
    plans = wanted.groupBy(*by, "query_id", "many").agg(
        F.sort_array(F.collect_list(F.struct("often", "token"))).alias("tokens")).filter(
        F.size("tokens") == F.col("many"))
    plans = store(plans.select(*by, "query_id", "many", F.col("tokens")[0]["token"].alias("token"), F.transform(
        F.slice("tokens", 2, F.greatest(F.size("tokens"), F.lit(1))), lambda t: t["token"]).alias("others")), "plans")
    rare, lists = _spread(plans, postings, "token")
    first = rare.join(lists, [*by, "token", "part"]).filter(F.col("n") >= F.col("many")).select(
        "query_id", "text_id", "many", "n", "others")
    alone = first.filter(F.size("others") == 0).select("query_id", "text_id", "many", "n")
    checked = first.filter(F.size("others") > 0).select(
        "query_id", "text_id", "many", "n", F.explode("others").alias("token")).join(
        postings.select("text_id", "token"), ["text_id", "token"]).groupBy(
        "query_id", "text_id", "many", "n").count().filter(F.col("count") == F.col("many") - 1).drop("count")
    found = store(alone.unionByName(checked).select(
        "query_id", "text_id", (F.col("many") / F.col("n")).alias("peso")), "found")
    # Of equal texts only the k smallest keys can be among the best; then the best of each query text.
    first_keys = Window.partitionBy("text_id").orderBy(doc_key)
    keyed = _keyed(docs, text, by, doc_key).withColumn("c", F.row_number().over(first_keys)).filter(
        F.col("c") <= k).drop("c")
    best = Window.partitionBy("query_id").orderBy(F.desc("peso"), doc_key)
    top = found.join(keyed, "text_id").withColumn("posto", F.row_number().over(best)).filter(
        F.col("posto") <= k).select("query_id", doc_key, "peso", "posto")
    return top.join(_keyed(queries, query, by, query_key).withColumnRenamed("text_id", "query_id"), "query_id").select(
        query_key, doc_key, "peso", "posto")
