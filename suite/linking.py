"""Record linkage of products with catalogue items, in its stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.functions import rules as R
from obralake.functions import text as T
from obralake.functions import vectors as V
from obralake.operators import calibration as C
from obralake.operators import linkage as L
from obralake.operators.neighbours import vector_topk
from obralake.plans import linkage as plan
from obralake.session import store

from . import products as X
from .common import table
from .texts import PAIRS_SQL, lex_stages, rule_pairs


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    items = store(X.items(spark, sf), "items")
    skus = store(X.products(spark, sf), "skus")
    return items, skus, store(L.tfidf_vectors(items, skus), "vectors")


def _by_sku(df: DataFrame, skus: DataFrame) -> DataFrame:
    return df.join(skus.select("sku_key", L.text_id(F.col("n")).alias("sid")), "sid")


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    items, skus, vectors = _sides(spark, sf)
    weights = L.term_weights(vectors)
    return weights.join(vectors.select("side", "doc", "n"), ["side", "doc"]).select(
        "side", "n", "term", F.round("w", 6).alias("w"), F.round("idf", 6).alias("idf"))


def tfidf_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of whole documents against the benchmark passages as corpus."""
    docs = table(spark, sf, "documents").select(T.normalize(F.col("text")).alias("n"))
    bench = table(spark, sf, "benchmark").select(T.normalize(F.col("text")).alias("n"))
    return L.strongest_terms(L.term_weights(L.tfidf_vectors(docs, bench)), 6).select(
        "side", "term", "n", F.round("idf", 6).alias("idf"), F.col("w").alias("maior"))


def tfidf_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest documents of each benchmark passage."""
    docs = store(table(spark, sf, "documents").select(
        F.col("doc_id").alias("item_key"), T.normalize(F.col("text")).alias("n")), "docs")
    bench = table(spark, sf, "benchmark").select(
        "item_id", T.normalize(F.col("text")).alias("n"))
    vectors = store(L.tfidf_vectors(docs, bench, asked_only=True).drop("n"), "vectors")
    near = L.preselect(docs, vectors, 10)
    return near.join(bench.select("item_id", L.text_id(F.col("n")).alias("sid")), "sid").select(
        "item_id", "item_key", "tf", F.col("posto").cast("bigint").alias("posto"))


def linkage_blocking(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs of product and item texts with a cosine of at least 0.5."""
    items, skus, vectors = _sides(spark, sf)
    near = L.pairs_above(vectors, 0.5)
    names = vectors.select("side", "doc", "n")
    return near.join(names.filter("side = 0").select(F.col("doc").alias("iid"), F.col("n").alias("item_n")), "iid").join(
        names.filter("side = 1").select(F.col("doc").alias("sid"), F.col("n").alias("sku_n")), "sid").select(
        "sku_n", "item_n", "tf")


def linkage_preselect(spark: SparkSession, sf: str) -> DataFrame:
    items, skus, vectors = _sides(spark, sf)
    return L.by_item(_by_sku(L.candidate_texts(items, vectors), skus)).select("sku_key", "item_key", "tf", "posto")


def _features(spark: SparkSession, sf: str) -> DataFrame:
    items, skus, vectors = _sides(spark, sf)
    return L.by_item(_by_sku(L.text_scores(L.candidate_texts(items, vectors), vectors), skus))


def linkage_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select(
        "sku_key", "item_key", "tf", F.round("cont", 9).alias("cont"), F.round("hit", 6).alias("hit"), F.round("ajuste", 12).alias("ajuste"),
        "head_ok")


def linkage_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select(
        "sku_key", "item_key", F.round("base", 9).alias("base"), "score")


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return plan.link(X.items(spark, sf), X.products(spark, sf))


def linkage_topk(spark: SparkSession, sf: str) -> DataFrame:
    out = _linked(spark, sf)
    rounded = ["score", "folga", F.round("medidas_batem", 6).alias("medidas_batem"), "alt2_score", "alt3_score"]
    return out.select("sku_key", "produto", "nivel", "item_codigo", "item_descricao", "item_unidade",
                      "preco", "alt2_codigo", "alt3_codigo", "alt2_descricao", "alt3_descricao", *rounded)


def linkage_margin(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf).select("sku_key", "score", "folga")


def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return L.tier_counts(_linked(spark, sf))


def linkage_v1(spark: SparkSession, sf: str) -> DataFrame:
    """First version: 60 candidates, containment first, harder tiers."""
    out = plan.link_v1(X.raw_items(spark, sf), X.raw_products(spark, sf))
    return out.select("sku_key", "nivel", "item_codigo", "score",
                      F.round("medidas_batem", 6).alias("medidas_batem"))


SIGNAL_VALUES = ("tf", "emb", "lex", "base", "score")


def linkage_three_signals(spark: SparkSession, sf: str) -> DataFrame:
    """All three signals, for all parts; a part has the vector of its key modulo their number."""
    vectors = table(spark, sf, "embeddings").select("vec_id", V.unit(F.col("embedding")).alias("vetor"))
    many = vectors.count()

    def with_vector(df: DataFrame, key: str) -> DataFrame:
        return df.join(vectors, F.pmod(key, F.lit(many)) == F.col("vec_id"), "left").drop("vec_id")

    items = with_vector(X.items(spark, sf), "item_key")
    skus = with_vector(X.products(spark, sf), "sku_key")
    # Of nine digits, and just above a half: no engine rounds it the other way.
    return plan.link_signals(items, skus).select("sku_key", "item_key", *[
        (F.floor(F.round(c, 9) * 1e6 + 0.50001) / 1e6).alias(c) for c in SIGNAL_VALUES])


def weighted_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Words and weights meet their part before the pairs do."""
    items, skus, vectors = _sides(spark, sf)
    words = L.text_features(vectors).select("sid", "words", "word_weights")
    tokens = L.item_features(vectors).select("iid", "item_tokens")
    joined = rule_pairs(
        spark, sf, skus.select("sku_key", L.text_id(F.col("n")).alias("sid")).join(words, "sid").drop("sid"),
        items.select("item_key", L.text_id(F.col("n")).alias("iid")).join(tokens, "iid").drop("iid"))
    cont = R.containment(F.col("words"), F.col("word_weights"), F.col("item_tokens"))
    return joined.select("sku_key", "item_key", F.round(cont, 6).alias("cont"))


def embedding_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Ten nearest vectors of each vector, itself included."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("a"), F.col("vec_id").alias("b"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    return vector_topk(vectors, vectors, 10, "a", "b").select(
        "a", "b", F.round("emb", 5).alias("emb"))


def regime_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """First non-relieved price of each part with its first relieved price beside it."""
    prices = table(spark, sf, "lineitem").filter("l_returnflag in ('N', 'R')").select(
        F.col("l_partkey").alias("codigo"),
        F.when(F.col("l_returnflag") == "N", "False").otherwise("True").alias("desonerado"),
        F.col("l_extendedprice").alias("preco_mediano"), F.col("l_quantity").alias("quantidade"),
        "l_shipdate", "l_orderkey", "l_linenumber")
    return L.price_sides(prices, ["l_shipdate", "l_orderkey", "l_linenumber", "preco_mediano"])


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    """The linkage's own first choices; the right item of a product is that of its part."""
    return _linked(spark, sf).select(
        F.lit("par").alias("rotulo"), F.col("sku_key").alias("gold_codigo"), "nivel",
        F.col("item_codigo").alias("top1"), "score")


def linkage_eval(spark: SparkSession, sf: str) -> DataFrame:
    return L.evaluate(_gold(spark, sf))


def linkage_threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return L.evaluate(_gold(spark, sf), [0.4, 0.5, 0.6, 0.75])


def calibration_curve(spark: SparkSession, sf: str) -> DataFrame:
    """The linkage's first choices under all three labels: of ten parts six have their own item as
    gold, one has another one, two have none and one only a relative."""
    found = _linked(spark, sf)
    digit = F.pmod("sku_key", F.lit(10))
    label = F.when(digit < 7, "par").when(digit < 9, "sem_par").otherwise("familia")
    gold = F.when(digit < 6, F.col("sku_key")).when(digit < 7, F.col("sku_key") + 1)
    return C.calibration_curve(found.select(
        label.alias("rotulo"), gold.alias("gold_codigo"), F.col("item_codigo").alias("top1"), "score")).select(
        "limite", "total", "certos", "outros", "familias", "nenhuns",
        *[F.round(c, 9).alias(c) for c in ("precisao", "alcance", "f1")])


QUERIES = {f.__name__: f for f in (
    calibration_curve, tfidf_weights, tfidf_documents, tfidf_cosine_topk, linkage_blocking, linkage_preselect,
    linkage_features, linkage_scores, linkage_topk, linkage_margin, tier_distribution, linkage_v1,
    linkage_three_signals, weighted_containment, embedding_topk, regime_pivot, linkage_eval,
    linkage_threshold_sweep)}


# ------------------------------------------------------------------ SQL twins

def tfidf_stages(items: str, skus: str) -> str:
    """CTEs up to w(side, n, term, w, idf) and dot(sn, cn, tf) for the texts of both sides."""
    return f"""
corpus AS (SELECT 0 AS side, n FROM {items} UNION ALL SELECT 1, n FROM {skus}),
txt AS (SELECT side, n, count(*) AS copies FROM corpus GROUP BY ALL),
tok AS (SELECT side, n, copies, {X.tokens_sql('n')} AS t FROM txt),
trm AS (SELECT side, n, copies, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM tok),
cnt AS (SELECT side, n, copies, term, count(*) AS c FROM trm GROUP BY ALL),
fre AS (SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + sum(copies))) + 1 AS idf FROM cnt GROUP BY term),
raw AS (SELECT side, n, term, idf, (1 + ln(c)) * idf AS r FROM cnt JOIN fre USING (term)),
w AS (SELECT side, n, term, idf, r / sqrt(sum(r * r) OVER (PARTITION BY side, n)) AS w FROM raw)"""


DOT_SQL = """
dot AS (SELECT s.n AS sn, c.n AS cn, round(sum(s.w * c.w), 9) AS tf FROM w s JOIN w c USING (term)
        WHERE s.side = 1 AND c.side = 0 GROUP BY ALL)"""


def preselect_sql(k: int) -> str:
    """All products against all items, ranked; pre(sku_key, item_key, sn, cn, tf, posto)."""
    return f"""{DOT_SQL},
alltexts AS (SELECT sn, item_key, cn, coalesce(tf, 0) AS tf FROM (SELECT DISTINCT n AS sn FROM sku)
  CROSS JOIN (SELECT item_key, n AS cn FROM item) LEFT JOIN dot USING (sn, cn)),
best AS (SELECT *, row_number() OVER (PARTITION BY sn ORDER BY tf DESC, item_key DESC) AS posto
         FROM alltexts QUALIFY posto <= {k}),
pre AS (SELECT sku_key, best.* FROM sku JOIN best ON sku.n = best.sn)"""


def cont_sql(words: str, tokens: str) -> str:
    weigh = "list_sum(list_transform({0}, lambda t: coalesce(im[t], 1)))"
    return (f"coalesce({weigh.format(f'list_filter({words}, lambda t: list_contains({tokens}, t))')}"
            f" / nullif({weigh.format(words)}, 0), 0)")


def measures_sql(x: str) -> str:
    scaled = f"{x} * (0.5::DOUBLE + 0.5::DOUBLE * hit)"
    return f"(CASE WHEN hit IS NULL THEN {x} WHEN hit = 0 THEN {scaled} * 0.6::DOUBLE ELSE {scaled} END)"


def grid_sql(x: str) -> str:
    return f"floor(({x}) * 1e9::DOUBLE + 0.50001::DOUBLE) / 1e9::DOUBLE"


LINK_SQL = f"{X.PRODUCT_SQL}, {tfidf_stages('item', 'sku')}"
IDF_MAP = "(SELECT map_from_entries(list((term, idf))) AS im FROM fre WHERE regexp_full_match(term, '[A-Z]{3,}'))"
FEAT_SQL = f"""{LINK_SQL}, {preselect_sql(40)},
sf AS (SELECT DISTINCT sn, {X.words_sql(X.tokens_sql('sn'))} AS words, {X.asked_sql('sn')} AS asked FROM pre),
cf AS (SELECT DISTINCT cn, {X.tokens_sql('cn')} AS toks, {X.numbers_sql('cn')} AS offered FROM pre),
sig AS (SELECT pre.*, {cont_sql('words', 'toks')} AS cont, {X.hit_sql('asked', 'offered')} AS hit,
  {X.adjustment_sql('sn', 'cn')} AS ajuste,
  words[1] IS NULL OR list_contains(toks[1:3], words[1]) AS head_ok
  FROM pre JOIN sf USING (sn) JOIN cf USING (cn), {IDF_MAP}),
feat AS (SELECT *, {grid_sql(f"{measures_sql('(0.8::DOUBLE * tf + 0.2::DOUBLE * cont)')} * ajuste * CASE WHEN head_ok THEN 1::DOUBLE ELSE 0.85::DOUBLE END")} AS score FROM sig),
rk AS (SELECT *, row_number() OVER (PARTITION BY sku_key ORDER BY score DESC, item_key DESC) AS r FROM feat),
top AS (SELECT sku_key, max(score) FILTER (r = 1) AS s1, max(item_key) FILTER (r = 1) AS k1,
  max(hit) FILTER (r = 1) AS h1, max(score) FILTER (r = 2) AS s2, max(item_key) FILTER (r = 2) AS k2,
  max(score) FILTER (r = 3) AS s3, max(item_key) FILTER (r = 3) AS k3 FROM rk WHERE r <= 3 GROUP BY sku_key),
res AS (SELECT *, round(s1 - s2, 9) AS folga, CASE
  WHEN s1 >= 0.60 AND coalesce(s1 - s2, 0) >= 0 AND (h1 IS NULL OR h1 >= 0.99) THEN 'alta'
  WHEN s1 >= 0.50 AND (h1 IS NULL OR h1 >= 0.99) THEN 'media' WHEN s1 >= 0.40 THEN 'baixa'
  ELSE 'sem_par' END AS nivel FROM top)"""

GOLD_SQL = f"""{FEAT_SQL},
gold AS (SELECT true AS par, sku_key AS g, nivel, CASE WHEN nivel <> 'sem_par' THEN k1 END AS top1, s1 AS score
  FROM res)"""
EVAL = """count(*) AS total, count(*) FILTER (par) AS pares, count(*) FILTER (par AND g = top1) AS certos,
round(count(*) FILTER (par AND g = top1) / count(*), 6) AS precisao"""

DOCS_TFIDF = f"""
{X.norm_stages('documents', 'dn', 'text')}, {X.norm_stages('benchmark', 'bn', 'text')},
{tfidf_stages('dn', 'bn')}"""

V1_RAW = f"""
raw_sku AS (SELECT p_partkey AS sku_key, {X.case(X.SKU_FORMS)} AS produto FROM part),
raw_item AS (SELECT p_partkey AS item_key, {X.case(X.ITEM_FORMS)} AS descricao FROM part),
{X.norm_stages('raw_sku', 'sku', 'produto', T.SYNONYMS_V1)},
{X.norm_stages('raw_item', 'item', 'descricao', T.SYNONYMS_V1)},
{tfidf_stages('item', 'sku')}, {preselect_sql(60)},
sf AS (SELECT DISTINCT sn, {X.words_sql(X.tokens_sql('sn'), T.NOISE_WORDS_V1)} AS words,
  list_distinct(regexp_extract_all(sn, '{T.MEASURE}')) AS asked FROM pre),
cf AS (SELECT DISTINCT cn, {X.tokens_sql('cn')} AS toks,
  list_distinct(regexp_extract_all(cn, '{T.MEASURE}')) AS offered FROM pre),
sig AS (SELECT pre.*, {cont_sql('words', 'toks')} AS cont, {X.hit_sql('asked', 'offered')} AS hit,
  words[1] IS NULL OR list_contains(toks[1:3], words[1]) AS head_ok
  FROM pre JOIN sf USING (sn) JOIN cf USING (cn), {IDF_MAP}),
feat AS (SELECT *, {grid_sql(f"{measures_sql('(0.7::DOUBLE * cont + 0.3::DOUBLE * tf)')} * CASE WHEN head_ok THEN 1::DOUBLE ELSE 0.7::DOUBLE END")} AS score FROM sig),
res AS (SELECT *, CASE WHEN score >= CASE WHEN hit IS NULL THEN 0.75 ELSE 0.6 END AND (hit IS NULL OR hit >= 0.99)
  THEN 'alta' WHEN score >= 0.55 THEN 'media' WHEN score >= 0.4 THEN 'baixa' ELSE 'sem_par' END AS nivel
  FROM feat QUALIFY row_number() OVER (PARTITION BY sku_key ORDER BY score DESC, item_key DESC) = 1)"""

# One vector per text, that of its lowest key; the dot product of all pairs of texts.
SIGNALS_SQL = f"""
v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(
        embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS e FROM embeddings),
c AS (SELECT count(*) AS many FROM embeddings),
iv AS (SELECT n, e FROM (SELECT n, arg_min(item_key, item_key) AS k FROM item GROUP BY n), c JOIN v ON vec_id = k % many),
sv AS (SELECT n, e FROM (SELECT n, arg_min(sku_key, sku_key) AS k FROM sku GROUP BY n), c JOIN v ON vec_id = k % many),
pr AS (SELECT s.n AS sn, i.n AS cn, round(least(1, greatest(0, list_dot_product(s.e, i.e))), 9) AS emb FROM sv s, iv i),
{lex_stages("pr", "sn", "cn")},
bs AS (SELECT sn, cn, coalesce(tf, 0) AS tf, emb, lex,
         {grid_sql("0.35::DOUBLE * coalesce(tf, 0) + 0.45::DOUBLE * emb + 0.2::DOUBLE * lex")} AS base
       FROM lx LEFT JOIN dot USING (sn, cn)),
pre AS (SELECT sku_key, p.* FROM sku JOIN (SELECT sn, item_key, cn, tf, emb, lex, base FROM bs JOIN item ON cn = item.n
  QUALIFY row_number() OVER (PARTITION BY sn ORDER BY base DESC, item_key DESC) <= 40) p ON sku.n = p.sn)"""

ORACLES = {
    "calibration_curve": f"""WITH {FEAT_SQL},
g AS (SELECT s1 AS limite, sku_key % 10 AS d, CASE WHEN nivel <> 'sem_par' THEN k1 END AS top1, sku_key FROM res),
o AS (SELECT limite, CASE WHEN d < 6 AND coalesce(sku_key = top1, false) OR d = 6 AND coalesce(sku_key + 1 = top1, false)
  THEN 'certo' WHEN d < 7 THEN 'outro' WHEN d < 9 THEN 'nenhum' ELSE 'familia' END AS o, d FROM g),
n AS (SELECT count(*) FILTER (d < 7) AS pares FROM o),
l AS (SELECT limite, count(*) FILTER (o = 'certo') AS a, count(*) FILTER (o = 'outro') AS b,
  count(*) FILTER (o = 'familia') AS c, count(*) FILTER (o = 'nenhum') AS e FROM o WHERE limite IS NOT NULL GROUP BY limite),
s AS (SELECT limite, CAST(sum(a) OVER w AS BIGINT) AS certos, CAST(sum(b) OVER w AS BIGINT) AS outros,
  CAST(sum(c) OVER w AS BIGINT) AS familias, CAST(sum(e) OVER w AS BIGINT) AS nenhuns FROM l WINDOW w AS (ORDER BY limite DESC)),
t AS (SELECT *, certos + outros + familias + nenhuns AS total FROM s)
SELECT limite, total, certos, outros, familias, nenhuns, round(certos / total, 9) AS precisao,
  round(certos / pares, 9) AS alcance, round(2 * certos / (total + pares), 9) AS f1 FROM t, n""",
    "linkage_three_signals": f"""WITH {LINK_SQL}, {DOT_SQL}, {SIGNALS_SQL},
sf AS (SELECT DISTINCT sn, {X.words_sql(X.tokens_sql('sn'))} AS words, {X.asked_sql('sn')} AS asked FROM pre),
cf AS (SELECT DISTINCT cn, {X.tokens_sql('cn')} AS toks, {X.numbers_sql('cn')} AS offered FROM pre),
sig AS (SELECT pre.*, {cont_sql('words', 'toks')} AS cont, {X.hit_sql('asked', 'offered')} AS hit,
  {X.adjustment_sql('sn', 'cn')} AS ajuste,
  words[1] IS NULL OR list_contains(toks[1:3], words[1]) AS head_ok
  FROM pre JOIN sf USING (sn) JOIN cf USING (cn), {IDF_MAP}),
val AS (SELECT *,
  {grid_sql(f"{measures_sql('(0.8::DOUBLE * base + 0.2::DOUBLE * cont)')} * ajuste * CASE WHEN head_ok THEN 1::DOUBLE ELSE 0.85::DOUBLE END")} AS score FROM sig)
SELECT sku_key, item_key, {", ".join(f"floor(round({c}, 9) * 1e6::DOUBLE + 0.50001::DOUBLE) / 1e6::DOUBLE AS {c}" for c in SIGNAL_VALUES)}
FROM val""",
    "tfidf_weights": f"""WITH {LINK_SQL}
SELECT side, n, term, round(w, 6) AS w, round(idf, 6) AS idf FROM w""",
    "tfidf_documents": f"""WITH {DOCS_TFIDF}
SELECT side, term, count(*) AS n, round(max(idf), 6) AS idf, round(max(w), 6) AS maior FROM w GROUP BY side, term""",
    "tfidf_cosine_topk": f"""WITH {DOCS_TFIDF}, {DOT_SQL},
r AS (SELECT b.item_id, d.doc_id AS item_key, coalesce(tf, 0) AS tf, row_number() OVER (
  PARTITION BY b.item_id ORDER BY coalesce(tf, 0) DESC, d.doc_id DESC) AS posto
  FROM bn b CROSS JOIN dn d LEFT JOIN dot ON dot.sn = b.n AND dot.cn = d.n QUALIFY posto <= 10)
SELECT item_id, item_key, tf, posto FROM r""",
    "linkage_blocking": f"""WITH {LINK_SQL}, {DOT_SQL}
SELECT sn AS sku_n, cn AS item_n, tf FROM dot WHERE tf >= 0.5""",
    "linkage_preselect": f"""WITH {LINK_SQL}, {preselect_sql(40)}
SELECT sku_key, item_key, tf, posto FROM pre""",
    "linkage_features": f"""WITH {FEAT_SQL}
SELECT sku_key, item_key, tf, round(cont, 9) AS cont, round(hit, 6) AS hit,
       round(ajuste, 12) AS ajuste, head_ok FROM feat""",
    "linkage_scores": f"""WITH {FEAT_SQL}
SELECT sku_key, item_key, tf AS base, score FROM feat""",
    "linkage_topk": f"""WITH {FEAT_SQL}
SELECT res.sku_key, produto, nivel, CASE WHEN nivel <> 'sem_par' THEN k1 END AS item_codigo,
  CASE WHEN nivel <> 'sem_par' THEN a.descricao END AS item_descricao,
  CASE WHEN nivel <> 'sem_par' THEN a.unidade END AS item_unidade,
  CASE WHEN nivel <> 'sem_par' THEN a.preco END AS preco, k2 AS alt2_codigo, k3 AS alt3_codigo,
  s1 AS score, folga, round(h1, 6) AS medidas_batem,
  s2 AS alt2_score, s3 AS alt3_score, b.descricao AS alt2_descricao, c.descricao AS alt3_descricao
FROM res JOIN raw_sku USING (sku_key) JOIN raw_item a ON k1 = a.item_key
LEFT JOIN raw_item b ON k2 = b.item_key LEFT JOIN raw_item c ON k3 = c.item_key""",
    "linkage_margin": f"""WITH {FEAT_SQL}
SELECT sku_key, s1 AS score, folga FROM res""",
    "tier_distribution": f"WITH {FEAT_SQL} SELECT nivel, count(*) AS quantidade FROM res GROUP BY nivel",
    "linkage_v1": f"""WITH {V1_RAW}
SELECT sku_key, nivel, CASE WHEN nivel <> 'sem_par' THEN item_key END AS item_codigo,
  score, round(hit, 6) AS medidas_batem FROM res""",
    "weighted_containment": f"""WITH {PAIRS_SQL}, {tfidf_stages('item', 'sku')},
sf AS (SELECT *, {X.words_sql(X.tokens_sql('sn'))} AS words, {X.tokens_sql('cn')} AS toks FROM texts)
SELECT sku_key, item_key, round({cont_sql('words', 'toks')}, 6) AS cont FROM sf, {IDF_MAP}""",
    "embedding_topk": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT x.vec_id AS a, y.vec_id AS b, round(least(1, greatest(0, list_dot_product(x.e, y.e))), 9) AS emb FROM v x, v y)
SELECT a, b, round(emb, 5) AS emb FROM d QUALIFY row_number() OVER (PARTITION BY a ORDER BY emb DESC, b DESC) <= 10""",
    "regime_pivot": """
WITH p AS (SELECT l_partkey AS codigo, l_returnflag AS f, l_extendedprice AS preco_mediano, l_quantity AS quantidade
  FROM lineitem WHERE l_returnflag IN ('N', 'R') QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) = 1)
SELECT n.codigo, n.preco_mediano, n.quantidade, r.preco_mediano AS preco_desonerado
FROM p n LEFT JOIN p r ON n.codigo = r.codigo AND r.f = 'R' WHERE n.f = 'N'""",
    "linkage_eval": f"WITH {GOLD_SQL} SELECT nivel, {EVAL} FROM gold GROUP BY nivel",
    "linkage_threshold_sweep": f"""WITH {GOLD_SQL}
SELECT limite, {EVAL} FROM gold, (SELECT unnest([0.4, 0.5, 0.6, 0.75])::DOUBLE AS limite)
WHERE score >= limite GROUP BY limite""",
}
