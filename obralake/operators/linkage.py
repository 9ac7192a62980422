"""Record linkage of product names with catalogue items.

Every product is compared with every item that can reach its top candidates, without a cross
join: equal texts are compared once, and an exact score bound decides which postings of the
shared terms have to be looked at. Nothing is capped; the bound only leaves out pairs that
provably rank below the last kept candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..session import store
from . import termblocks

# Signal weights, tier limits, the width of the pre-selection, shares of the score.
WEIGHTS = {"emb": 0.45, "lex": 0.20, "tf": 0.35}
ACCEPT, REVIEW, FAMILY = 0.60, 0.50, 0.40
MIN_MARGIN = 0.0
CANDIDATES, CANDIDATES_V1 = 40, 60
BASE_SHARE, CONT_SHARE, NO_HEAD = 0.8, 0.2, 0.85
CONT_SHARE_V1, TF_SHARE_V1, NO_HEAD_V1 = 0.7, 0.3, 0.7
ACCEPT_V1, ACCEPT_BARE_V1, REVIEW_V1, FAMILY_V1 = 0.60, 0.75, 0.55, 0.40

# Scores equal to this many digits are ties; then the higher item key wins.
SCORE_DIGITS = 9
SLACK = 1e-8
# A term found in more texts than this is spread over several join keys.
TERM_SPREAD = 100_000
# Seeds come from lists of at most this many items per term.
SEED_LIST = 250
# Seeds of a product that are compared in any case, however many copies they stand for.
SEEDS = 8
# Product texts that all items are compared with, in blocks, as they are so few.
FEW = 2048
# Width of the term signature of an item, in 64-bit words.
SIGNATURE_WORDS = 4
# Terms of a product that are checked against the signature one by one; others count in full.
CHECKED = 16


# ---------------------------------------------------------------- texts and weights

def text_id(text: Column) -> Column:
    """16-byte digest: half the size of its hex form in every pair that is shuffled."""
    return F.unhex(F.md5(text))


def distinct_texts(df: DataFrame, text: str = "n") -> DataFrame:
    """One row per text with its number of copies and a digest as id."""
    counted = df.groupBy(F.col(text).alias("n")).agg(F.count("*").alias("copies"))
    return counted.withColumn("doc", text_id(F.col("n")))


def term_counts(texts: DataFrame, stop=T.STOP_WORDS) -> DataFrame:
    """How often each text, by its number `no`, has each term. Texts are dealt out, their terms are not:
    those of a text are counted where it lies."""
    words = T.tokens(F.col("n"), stop)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select("no", "n", "copies").repartition(parts, "no").select(
        "no", "copies", F.explode(T.terms(words)).alias("term")).groupBy(
        "no", "term").agg(F.count("*").alias("tf"), F.first("copies").alias("copies"))


def idf_column(n_docs: Column, df: Column) -> Column:
    return F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + 1.0


def _signature_slot(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(64 * SIGNATURE_WORDS)).cast("int")


def signature(terms: Column) -> Column:
    """Bit set of hashed terms; a term whose bit is off is certainly absent."""
    slots = F.transform(terms, _signature_slot)

    def word(index: int) -> Column:
        mine = F.filter(slots, lambda p: F.floor(p / 64) == index)
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, p: acc.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(p, F.lit(64)))))

    return F.array(*[word(i) for i in range(SIGNATURE_WORDS)])


def tfidf_vectors(items: DataFrame, skus: DataFrame, text: str = "n", asked_only: bool = False) -> DataFrame:
    """Unit TF-IDF vector of every distinct text of both sides.

    side 0 = items, 1 = products; the corpus for the document frequencies is all rows of both.
    Columns: side, doc, n, copies, terms (array of term, w, idf, df) and sig, their signature. With
    `asked_only`, items list only terms that a product has: all that a cosine with one needs.
    """
    texts = items.select(F.lit(0).alias("side"), F.col(text).alias("n")).unionByName(
        skus.select(F.lit(1).alias("side"), F.col(text).alias("n")))
    weighed = termblocks.vectors(texts, items.count() + skus.count(), T.STOP_WORDS, asked_only)
    sig = F.when(F.col("terms").isNotNull(), signature(F.transform("terms", lambda t: t["term"])))
    return weighed.select("side", text_id(F.col("n")).alias("doc"), "n", "copies", "terms", sig.alias("sig"))


def term_weights(vectors: DataFrame, *more: str) -> DataFrame:
    """The vectors in long form: side, doc, sig, `more`, term, w, idf, df."""
    return vectors.select("side", "doc", "sig", *more, F.explode("terms").alias("t")).select(
        "side", "doc", "sig", *more, "t.*")


def strongest_terms(weights: DataFrame, digits: int) -> DataFrame:
    """Each side's terms with the number of texts that have them, their idf and greatest weight, the latter to
    `digits`: side, term, n, idf, w."""
    return termblocks.strongest(weights, digits)


# ---------------------------------------------------------------- exact pruned join

def posting_lists(vectors: DataFrame, side: int, id_name: str, weight: str) -> DataFrame:
    spread = F.greatest(F.ceil(F.col("df") / TERM_SPREAD), F.lit(1)).cast("int")
    return term_weights(vectors.filter(F.col("side") == side), "copies").select(
        F.col("doc").alias(id_name), "term", F.col("w").alias(weight), "sig", spread.alias("spread"), "copies",
        (F.col("w") / F.col("idf")).alias("rate"))


def bounded_terms(vectors: DataFrame, postings: DataFrame) -> DataFrame:
    """Terms of each product text, with what the more common ones can still add.

    rest_ub: their greatest total; rest_sq: the squared weight they hold.
    """
    # Stored, so that its size is known before all terms of the products would be shuffled to meet it.
    stats = store(postings.groupBy("term").agg(
        F.max("wi").alias("max_wi"), F.count("*").alias("n_items")), "stats")
    mine = posting_lists(vectors, 1, "sid", "ws").drop("sig", "copies").join(stats, "term")
    common_first = Window.partitionBy("sid").orderBy(F.desc("n_items"), F.desc("term"))
    before = common_first.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    return mine.withColumns({
        "rest_ub": F.coalesce(F.sum(F.col("ws") * F.col("max_wi")).over(before), zero),
        "rest_sq": F.coalesce(F.sum(F.col("ws") * F.col("ws")).over(before), zero)})


def slots(terms: DataFrame) -> DataFrame:
    """Signature slot and bound of every product term: word, bit, most."""
    slot = _signature_slot(F.col("term"))
    return terms.withColumns({
        "word": F.floor(slot / 64).cast("int"), "bit": F.pmod(slot, F.lit(64)),
        "most": F.col("ws") * F.col("max_wi")})


def _with_checks(terms: DataFrame) -> DataFrame:
    """Adds the product's CHECKED strongest terms as parallel arrays, and the total of the rest.

    Parallel arrays of fixed length keep the bound inside generated code. Products are of one `kind`
    if they have the same terms of items in the same proportions: their cosines with any item are
    to each other as their `scale`.
    """
    mine = Window.partitionBy("sid")
    everything = F.sort_array(F.collect_list(F.struct("most", "word", "bit")).over(mine), asc=False)
    listed = terms.withColumns({"_all": everything, "scale": F.min("rate").over(mine)})
    share = F.concat_ws("=", "term", F.round(F.col("rate") / F.col("scale"), SCORE_DIGITS).cast("string"))
    listed = listed.withColumn("kind", text_id(F.array_join(F.sort_array(F.collect_list(share).over(mine)), "|")))
    padding = F.array_repeat(F.struct(F.lit(0.0).alias("most"), F.lit(0).alias("word"),
                                      F.lit(0).alias("bit")), CHECKED)
    first = F.slice(F.concat(F.slice("_all", 1, CHECKED), padding), 1, CHECKED)
    listed = listed.withColumn("_first", first)
    rest = F.aggregate(F.slice("_all", F.lit(CHECKED + 1), F.size("_all")), F.lit(0.0),
                       lambda acc, a: acc + a["most"])
    return listed.withColumns({
        "mosts": F.transform("_first", lambda a: a["most"]),
        "words": F.transform("_first", lambda a: a["word"]),
        "bits": F.transform("_first", lambda a: a["bit"]), "unchecked": rest}).drop("_all", "_first")


CHECKS = ["mosts", "words", "bits", "unchecked"]


def _attainable() -> Column:
    """Upper bound of a pair's cosine from the item's signature."""
    total = F.col("unchecked")
    for i in range(CHECKED):
        has = F.getbit(F.get("sig", F.get("words", F.lit(i))), F.get("bits", F.lit(i)))
        total = total + F.when(has == 1, F.get("mosts", F.lit(i))).otherwise(F.lit(0.0))
    return total


def add_terms(pairs: DataFrame, open_terms: DataFrame, postings: DataFrame,
               keep: Sequence[str] = ()) -> DataFrame:
    """Cosine of (sid, iid): `so_far` plus what the product's open terms add.

    `open_terms`: sid, term, ws, word, bit. Only terms that the item's signature shows are
    fetched, by (item, term), a key without hot values; whole vectors never move.
    """
    listed = open_terms.groupBy("sid").agg(
        F.collect_list(F.struct("term", "ws", "word", "bit")).alias("open"))
    # An entry without a term keeps pairs that have nothing left to fetch.
    last = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("ws"),
                            F.lit(0).alias("word"), F.lit(0).alias("bit")))
    asked = pairs.join(listed, "sid", "left").select(
        "sid", "iid", *keep, "so_far", "sig",
        F.explode(F.when(F.col("open").isNull(), last).otherwise(F.concat("open", last))).alias("o"))
    asked = asked.filter(F.col("o.term").isNull() | (
        F.getbit(F.get("sig", F.col("o.word")), F.col("o.bit")) == 1)).select(
        "sid", "iid", *keep, "so_far", F.col("o.term").alias("term"), F.col("o.ws").alias("ws"))
    met = asked.join(postings.select("iid", "term", "wi"), ["iid", "term"], "left")
    return met.groupBy("sid", "iid").agg(
        *[F.first(c).alias(c) for c in keep],
        F.round(F.first("so_far") + F.coalesce(F.sum(F.col("ws") * F.col("wi")), F.lit(0.0)),
                SCORE_DIGITS).alias("tf"))


def checked_terms(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of the items, and the products' terms with bounds and signature checks, stored."""
    postings = posting_lists(vectors, 0, "iid", "wi")
    checked = store(_with_checks(slots(bounded_terms(vectors, postings))), "checked")
    # Postings of terms that no product has are never asked for.
    shared = store(checked.select("term").distinct(), "shared")
    return postings.join(shared, "term", "left_semi"), checked


def pairs_above(vectors: DataFrame, limits: DataFrame | float,
                terms: tuple[DataFrame, DataFrame] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All text pairs (sid, iid, tf) whose cosine reaches the product's limit (above zero).

    A pair is found through its rarest shared term, so a term is looked up only while it and the
    more common ones together can reach the limit. Within the join, the item's term signature
    bounds what all terms of the product can add; only pairs that may reach the limit are
    shuffled. Their looked-up terms are summed there and the common rest is fetched per pair.
    `limits` is one number, or sid → `limit`; `terms` are `checked_terms`, if they are at hand.
    `keep` names what else of the item is wanted: its `copies`.
    """
    postings, bounded = terms or checked_terms(vectors)
    if isinstance(limits, DataFrame):
        bounded = bounded.join(limits, "sid")
    else:
        bounded = bounded.withColumn("limit", F.lit(float(limits)))
    floor = F.col("limit") - SLACK
    reach = F.least(F.col("most") + F.col("rest_ub"),
                    F.sqrt(F.col("ws") * F.col("ws") + F.col("rest_sq")))
    checked = bounded.withColumn("reaches", reach >= floor)
    looked_up = checked.filter("reaches").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)))
    spread_postings = postings.select(
        "term", "iid", "wi", "sig", *keep, F.pmod(F.xxhash64("iid"), F.col("spread")).cast("int").alias("part"))
    found = looked_up.select("sid", "term", "part", "ws", "limit", *CHECKS).join(
        spread_postings, ["term", "part"]).filter(_attainable() >= floor)
    pairs = found.groupBy("sid", "iid").agg(
        F.sum(F.col("ws") * F.col("wi")).alias("so_far"),
        *[F.first(c).alias(c) for c in ("limit", "sig", *keep)])
    return add_terms(pairs, checked.filter("not reaches"), postings, ["limit", *keep]).filter(
        (F.col("tf") >= floor) & (F.col("tf") > 0)).select("sid", "iid", "tf", *keep)


def seed_limits(vectors: DataFrame, k: int, terms: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """A lower bound of every product text's k-th best cosine, copies of items counted: sid → limit.

    Seeds are the most promising of the heaviest items of the product's rarest terms. Lists and
    seeds per product are bounded whatever a term's frequency; that only weakens the bound, never
    the result. Seeds that stand for many copies fill the k sooner, so fewer are compared. Too few
    seeds give 0. One product of each kind is compared; its limit holds for the others to scale.
    """
    postings, checked = terms or checked_terms(vectors)
    leaders = store(checked.groupBy("kind").agg(F.min("sid").alias("sid")), "leaders")
    leading = checked.join(leaders.select("sid"), "sid", "left_semi")
    heaviest = Window.partitionBy("term").orderBy(F.desc("wi"), "iid")
    champions = postings.withColumn("r", F.row_number().over(heaviest)).filter(
        F.col("r") <= SEED_LIST).select("term", "iid", "sig", "copies")
    rare_first = Window.partitionBy("sid").orderBy("n_items", "term").rowsBetween(
        Window.unboundedPreceding, -1)
    listed = F.least(F.col("n_items"), F.lit(SEED_LIST))
    chosen = leading.withColumn("ahead", F.coalesce(F.sum(listed).over(rare_first), F.lit(0))).filter(F.col("ahead") < 2 * k).select("sid", "term", *CHECKS)
    promising = Window.partitionBy("sid").orderBy(F.desc("most"), "iid")
    seeds = chosen.join(champions, "term").select(
        "sid", "iid", "sig", "copies", _attainable().alias("most")).groupBy("sid", "iid").agg(
        *[F.first(c).alias(c) for c in ("sig", "copies", "most")]).withColumns({
        "r": F.row_number().over(promising),
        "reached": F.sum("copies").over(promising.rowsBetween(Window.unboundedPreceding, 0))}).filter(
        (F.col("reached") - F.col("copies") < 3 * k) | (F.col("r") <= SEEDS)).filter(
        F.col("r") <= 3 * k).select("sid", "iid", "sig", "copies", F.lit(0.0).alias("so_far"))
    best_first = Window.partitionBy("sid").orderBy(F.desc("tf"), "iid").rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = add_terms(seeds, leading, postings, ["copies"]).withColumn(
        "reached", F.sum("copies").over(best_first))
    reached = ranked.groupBy("sid").agg(
        F.max(F.when(F.col("reached") >= k, F.col("tf"))).alias("limit"))
    led = leading.select("sid", "kind", F.col("scale").alias("led_by")).distinct().join(
        reached, "sid").drop("sid")
    # Limits and shares are rounded: a little less is certain.
    to_scale = (F.col("limit") * (1.0 - SLACK) - SLACK) * F.col("scale") / F.col("led_by")
    limits = checked.select("sid", "kind", "scale").distinct().join(led, "kind").select(
        "sid", F.greatest(to_scale, F.lit(0.0)).alias("limit"))
    everyone = vectors.filter("side = 1").select(F.col("doc").alias("sid"))
    return everyone.join(limits, "sid", "left").select(
        "sid", F.coalesce("limit", F.lit(0.0)).alias("limit"))


def topk_texts(vectors: DataFrame, k: int) -> DataFrame:
    """Pairs that contain the texts of every product text's k best items by cosine (positive ones).

    An item text stands for its copies: texts that score less than k items do are left out. `ahead` is
    the number of items that score more than the text. Up to FEW products are compared with all items, more
    than that by the terms they share, as far as bounds allow.
    """
    if vectors.filter("side = 1").limit(FEW + 1).count() <= FEW:
        found = termblocks.best_pairs(vectors, k).select(
            "sid", "iid", F.round("cosine", SCORE_DIGITS).alias("tf"), "copies").filter("tf > 0")
    else:
        terms = checked_terms(vectors)
        limits = store(seed_limits(vectors, k, terms), "limits")
        found = pairs_above(vectors, limits, terms, ["copies"])
    best = Window.partitionBy("sid").orderBy(F.desc("tf"))
    ahead = F.sum("copies").over(best) - F.sum("copies").over(Window.partitionBy("sid", "tf"))
    return found.withColumn("ahead", ahead).filter(F.col("ahead") < k).drop("copies")


# ---------------------------------------------------------------- candidates and scores

def highest_keys(items: DataFrame, k: int, key: str = "item_key", text: str = "n") -> DataFrame:
    """The k highest keys of every item text: iid, key. Copies score alike, so no others can be kept."""
    copies = Window.partitionBy("iid").orderBy(F.desc(key))
    return items.select(key, text_id(F.col(text)).alias("iid")).withColumn(
        "c", F.row_number().over(copies)).filter(F.col("c") <= k).drop("c")


def expand_items(pairs: DataFrame, items: DataFrame, k: int, order: str,
                 key: str = "item_key", text: str = "n") -> DataFrame:
    """Text pairs (sid, iid, …) to the k best items per product text, with their rank `posto`."""
    best = Window.partitionBy("sid").orderBy(F.desc(order), F.desc(key))
    return pairs.join(highest_keys(items, k, key, text), "iid").select(
        "sid", key, "iid", *[c for c in pairs.columns if c not in ("sid", "iid")]).withColumn(
        "posto", F.row_number().over(best)).filter(F.col("posto") <= k)


def candidate_texts(items: DataFrame, vectors: DataFrame, k: int = CANDIDATES,
                    key: str = "item_key", text: str = "n") -> DataFrame:
    """The k best items of every product text by cosine, by pair of texts: sid, iid, tf, items.

    `items` lists the text's items among them, item key and `posto`, best first. Products with fewer than
    k related items are filled up with the highest unrelated keys. Only pairs of texts are shuffled; a
    product's candidates are ranked within its row.
    """
    # Stored, so that its size is known: a small one meets the pairs where they lie.
    keyed = store(highest_keys(items, k, key, text).groupBy("iid").agg(
        F.sort_array(F.collect_list(F.struct(key)), asc=False).alias("keys")), "keys")
    # Of a text that k - n items score less than, only so many keys can count.
    texts = topk_texts(vectors, k).join(keyed, "iid").groupBy("sid").agg(F.collect_list(F.struct(
        "tf", "iid", F.slice("keys", 1, (k - F.col("ahead")).cast("int")).alias("keys"))).alias("texts"))
    every = F.flatten(F.transform("texts", lambda t: F.transform(t["keys"], lambda x: F.struct(
        t["tf"].alias("tf"), x[key].alias(key), t["iid"].alias("iid")))))
    ranked = vectors.filter("side = 1").select(F.col("doc").alias("sid")).join(texts, "sid", "left").select(
        "sid", F.slice(F.sort_array(F.coalesce(every, F.array()), asc=False), 1, k).alias("related"))
    # A product with m related items needs k - m others; they are among the last 2k keys.
    last_keys = items.select(key, text_id(F.col(text)).alias("iid")).orderBy(F.desc(key)).limit(
        2 * k).agg(F.sort_array(F.collect_list(F.struct(key, "iid")), asc=False).alias("last"))
    m = F.size("related")
    others = F.slice(F.filter("last", lambda x: ~F.coalesce(F.exists(
        "related", lambda c: c[key] == x[key]), F.lit(False))), F.lit(1), k - m)
    fill = F.when(m < k, F.transform(others, lambda x: F.struct(
        F.lit(0.0).alias("tf"), x[key].alias(key), x["iid"].alias("iid"))))
    chosen = ranked.crossJoin(last_keys).withColumn("all", F.concat("related", F.coalesce(fill, F.array()))).select("sid", F.transform(
        "all", lambda c, i: F.struct(c["iid"], c["tf"], c[key], (i + 1).cast("bigint").alias("posto"))).alias("all"))
    pairs = chosen.select("sid", "all", F.explode(F.array_distinct(F.transform(
        "all", lambda c: F.struct(c["iid"], c["tf"])))).alias("t"))
    mine = F.filter("all", lambda c: c["iid"].eqNullSafe(F.col("t.iid")) & (c["tf"] == F.col("t.tf")))
    return pairs.select("sid", "t.iid", "t.tf", F.transform(
        mine, lambda c: F.struct(c[key], c["posto"])).alias("items"))


def by_item(pairs: DataFrame, key: str = "item_key", most: int | None = None) -> DataFrame:
    """Pairs of texts with their `items` to one row per item, the `most` best ones of each pair."""
    listed = F.col("items") if most is None else F.slice("items", 1, most)
    return pairs.withColumn("c", F.explode(listed)).select(
        "*", F.col(f"c.{key}").alias(key), F.col("c.posto").alias("posto")).drop("c", "items")


def preselect(items: DataFrame, vectors: DataFrame, k: int = CANDIDATES,
              key: str = "item_key", text: str = "n") -> DataFrame:
    """The k best items of every product text by cosine: sid, item key, iid, tf, posto."""
    return by_item(candidate_texts(items, vectors, k, key, text), key).select("sid", key, "iid", "tf", "posto")


def to_grid(score: Column) -> Column:
    """Half-up to SCORE_DIGITS, spelled out so that every engine lands on the same side."""
    scale = float(10 ** SCORE_DIGITS)
    return F.floor(score * scale + 0.50001).cast("double") / scale


def effective_weights(present: Sequence[str], weights: dict[str, float] | None = None) -> dict[str, float]:
    """Weights of the signals at hand, rescaled to sum 1."""
    base = weights or WEIGHTS
    total = sum(w for s, w in base.items() if s in present)
    return {s: (base[s] / total if s in present else 0.0) for s in base}


def base_score(present: Sequence[str], weights: dict[str, float] | None = None) -> Column:
    eff = effective_weights(present, weights)
    return sum((F.lit(eff[s]) * F.col(s) for s in present), F.lit(0.0))


def idf_map(terms: Column) -> Column:
    return F.map_from_entries(F.transform(terms, lambda t: F.struct(t["term"], t["idf"])))


def text_features(vectors: DataFrame) -> DataFrame:
    """Per product text what the rules need, computed once per text and not per pair."""
    tokens = T.tokens(F.col("n"))
    words = T.significant_words(tokens)
    weights = F.transform(words, lambda w: F.coalesce(
        F.try_element_at(idf_map(F.col("terms")), w), F.lit(1.0)))
    return vectors.filter("side = 1").select(
        F.col("doc").alias("sid"), F.col("n").alias("sn"), words.alias("words"),
        weights.alias("word_weights"), R.asked_numbers(F.col("n")).alias("asked"),
        T.measures(F.col("n")).alias("sku_measures"))


def item_features(vectors: DataFrame) -> DataFrame:
    return vectors.filter("side = 0").select(
        F.col("doc").alias("iid"), F.col("n").alias("cn"), T.tokens(F.col("n")).alias("item_tokens"),
        T.numbers(F.col("n")).alias("offered"), T.amp_ranges(F.col("n")).alias("ranges"),
        T.measures(F.col("n")).alias("item_measures"))


def text_scores(texts: DataFrame, vectors: DataFrame, present: Sequence[str] = ("tf",)) -> DataFrame:
    """Rule signals and the second-version score of pairs of texts, beside their other columns."""
    offers = store(item_features(vectors), "offers")
    joined = texts.join(offers, "iid").join(text_features(vectors), "sid")
    hit = R.hit_ratio(F.col("asked"), F.col("offered"), F.col("ranges"))
    known = joined.select(
        "*", to_grid(base_score(present)).alias("base"), hit.alias("hit"),
        R.containment(F.col("words"), F.col("word_weights"), F.col("item_tokens")).alias("cont"),
        R.type_adjustment(F.col("sn"), F.col("cn")).alias("ajuste"),
        R.head_word_ok(F.col("words"), F.col("item_tokens")).alias("head_ok"))
    mixed = R.apply_measures(BASE_SHARE * F.col("base") + CONT_SHARE * F.col("cont"), F.col("hit"))
    score = mixed * F.col("ajuste") * F.when(F.col("head_ok"), 1.0).otherwise(NO_HEAD)
    return known.withColumn("score", to_grid(score)).drop(
        "words", "word_weights", "item_tokens", "asked", "offered", "ranges",
        "sku_measures", "item_measures")


def features(pairs: DataFrame, vectors: DataFrame, present: Sequence[str] = ("tf",)) -> DataFrame:
    """Rule signals and the second-version score of candidate pairs, computed once per pair of texts."""
    texts = pairs.select("sid", "iid", *present).dropDuplicates(["sid", "iid"])
    return pairs.join(text_scores(texts, vectors, present).drop(*present), ["sid", "iid"])


def features_v1(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """First version: containment and cosine, measures with their units, harder head rule."""
    offers = store(item_features(vectors), "offers")
    joined = pairs.join(offers, "iid").join(text_features(vectors), "sid")
    tokens = T.tokens(F.col("sn"))
    words = T.significant_words(tokens, T.NOISE_WORDS_V1)
    idf = F.col("sku_idf")
    weights = F.transform(words, lambda w: F.coalesce(F.try_element_at(idf, w), F.lit(1.0)))
    with_idf = joined.join(vectors.filter("side = 1").select(
        F.col("doc").alias("sid"), idf_map(F.col("terms")).alias("sku_idf")), "sid")
    met = F.size(F.array_intersect("sku_measures", "item_measures"))
    hit = met / F.nullif(F.size("sku_measures"), F.lit(0))
    known = with_idf.select(
        "*", hit.alias("hit"), R.containment(words, weights, F.col("item_tokens")).alias("cont"),
        R.head_word_ok(words, F.col("item_tokens")).alias("head_ok"))
    mixed = R.apply_measures(CONT_SHARE_V1 * F.col("cont") + TF_SHARE_V1 * F.col("tf"), F.col("hit"))
    score = mixed * F.when(F.col("head_ok"), 1.0).otherwise(NO_HEAD_V1)
    return known.withColumn("score", to_grid(score)).select(
        "sid", "iid", *[c for c in pairs.columns if c not in ("sid", "iid")],
        "hit", "cont", "head_ok", "score")


# ---------------------------------------------------------------- decision

def measures_ok(hit: Column) -> Column:
    return hit.isNull() | (hit >= 0.99)


def tier(score: Column, margin: Column, hit: Column) -> Column:
    ok = measures_ok(hit)
    wide = F.coalesce(margin, F.lit(0.0)) >= MIN_MARGIN
    return (F.when((score >= ACCEPT) & wide & ok, "alta").when((score >= REVIEW) & ok, "media")
            .when(score >= FAMILY, "baixa").otherwise("sem_par"))


def tier_v1(score: Column, hit: Column) -> Column:
    needed = F.when(hit.isNull(), F.lit(ACCEPT_BARE_V1)).otherwise(F.lit(ACCEPT_V1))
    return (F.when((score >= needed) & measures_ok(hit), "alta").when(score >= REVIEW_V1, "media")
            .when(score >= FAMILY_V1, "baixa").otherwise("sem_par"))


def top_three(scored: DataFrame, key: str = "item_key", by: str = "sid") -> DataFrame:
    """Best candidate with its margin, measure hit and two alternates (null when absent)."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.desc(key))
    ranked = scored.select(by, key, "score", "hit").withColumn(
        "r", F.row_number().over(order)).filter(F.col("r") <= 3)

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("r") == rank, F.col(column)))

    wide = ranked.groupBy(by).agg(
        *[at(i, c).alias(f"{c}{i}") for i in (1, 2, 3) for c in (key, "score")],
        at(1, "hit").alias("hit"))
    margin = F.round(F.col("score1") - F.col("score2"), SCORE_DIGITS)
    return wide.withColumn("folga", margin).withColumn(
        "nivel", tier(F.col("score1"), F.col("folga"), F.col("hit")))


def best_one(scored: DataFrame, key: str = "item_key", by: str = "sid") -> DataFrame:
    best = scored.groupBy(by).agg(F.max_by(
        F.struct("score", key, "hit"), F.struct("score", key)).alias("b"))
    return best.select(by, "b.*").withColumn("nivel", tier_v1(F.col("score"), F.col("hit")))


def tier_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("nivel").agg(F.count("*").alias("quantidade"))


def price_sides(prices: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per code from its first SEM price row, with the first COM price beside it.

    Both regimes come out of one grouping, so no join is needed.
    """
    rank = F.struct(*order)
    sem = F.col("desonerado") == "False"
    com = F.col("desonerado") == "True"
    hidden = {"codigo", "desonerado", *order} - {"preco_mediano"}
    fields = [c for c in prices.columns if c not in hidden]
    out = prices.groupBy("codigo").agg(
        F.min_by(F.when(sem, F.struct(*fields)), F.when(sem, rank)).alias("s"),
        F.min_by(F.when(com, F.col("preco_mediano")), F.when(com, rank)).alias("preco_desonerado"))
    return out.filter(F.col("s").isNotNull()).select("codigo", "s.*", "preco_desonerado")


def evaluate(gold: DataFrame, limits: Sequence[float] = ()) -> DataFrame:
    """Per tier: size, rows labelled as a pair, and right first choices.

    `gold` holds rotulo, gold_codigo, nivel, top1 (and score for a limit sweep).
    """
    right = (F.col("rotulo") == "par") & (F.col("gold_codigo") == F.col("top1"))
    if limits:
        gold = gold.withColumn("limite", F.explode(F.array(*map(F.lit, limits)))).filter(
            F.col("score") >= F.col("limite"))
        by = ["limite"]
    else:
        by = ["nivel"]
    return gold.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(F.col("rotulo") == "par").alias("pares"),
        F.count_if(right).alias("certos")).withColumn(
        "precisao", F.round(F.col("certos") / F.col("total"), 6))
