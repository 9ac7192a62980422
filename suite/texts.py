"""Text normalisation and the pairwise rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.functions import lexical
from obralake.functions import rules as R
from obralake.functions import text as T
from obralake.operators import search
from obralake.operators import star

from . import products as X
from .common import table


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents in comparable form."""
    return table(spark, sf, "documents").select("doc_id", T.normalize(F.col("text")).alias("n"))


def normalize_text_v1(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_products(spark, sf).select(
        "sku_key", T.normalize(F.col("produto"), T.SYNONYMS_V1).alias("n"))


def normalize_products(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of the linkage, normalised and standardised."""
    return X.products(spark, sf).select("sku_key", "n").join(
        X.items(spark, sf).select(F.col("item_key").alias("sku_key"), F.col("n").alias("item_n")),
        "sku_key")


def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.normalize(F.col("text")).alias("n"))
    tokens = docs.select("doc_id", T.tokens(F.col("n")).alias("t"))
    words = T.significant_words(F.col("t"))
    return tokens.select("doc_id", F.array_join("t", " ").alias("tokens"),
                         F.array_join(words, " ").alias("palavras"))


def strip_codes(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.normalize(F.col("text")).alias("n"))
    return docs.select("doc_id", T.strip_codes(F.col("n")).alias("n"))


def extract_measures(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.normalize(F.col("text")).alias("n"))
    return docs.select("doc_id", F.array_join(F.array_sort(T.measures(F.col("n"))), " ").alias("medidas"),
                       F.array_join(F.array_sort(T.numbers(F.col("n"))), " ").alias("numeros"))


def plate_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """Gang sums, plate sizes and `1M` on the upper-cased raw names, where `+` survives."""
    raw = X.raw_products(spark, sf).select("sku_key", T.ascii_upper(F.col("produto")).alias("u"))
    return raw.select("sku_key", T.standardize(F.col("u")).alias("n"))


def attribute_extract(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n")
    amps = F.transform(T.amperages(n), lambda a: F.format_string("%.2f", a))
    return X.products(spark, sf).select(
        "sku_key", T.pole_count(n).alias("polos"), T.gang_count(n).alias("postos"),
        T.plate_size(n).alias("tamanho"), F.array_join(amps, " ").alias("amperes"))


def rule_pairs(spark: SparkSession, sf: str, skus: DataFrame | None = None,
               items: DataFrame | None = None) -> DataFrame:
    """Every part sold by a supplier, beside the item that has the supplier's number.

    `skus` and `items` hold what is wanted of each side beside its key; without them, the texts.
    """
    skus = skus or X.products(spark, sf).select("sku_key", F.col("n").alias("sn"))
    items = items or X.items(spark, sf).select("item_key", F.col("n").alias("cn"))
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("sku_key"), F.col("l_suppkey").alias("item_key")).distinct()
    return pairs.join(skus, "sku_key").join(items, "item_key")


def measure_hit(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers are read once per text, not per pair."""
    n = F.col("n")
    skus = X.products(spark, sf).select("sku_key", R.asked_numbers(n).alias("asked"))
    items = X.items(spark, sf).select("item_key", T.numbers(n).alias("offered"), T.amp_ranges(n).alias("ranges"))
    hit = R.hit_ratio(F.col("asked"), F.col("offered"), F.col("ranges"))
    return rule_pairs(spark, sf, skus, items).select("sku_key", "item_key", F.round(hit, 6).alias("hit"))


def type_rules(spark: SparkSession, sf: str) -> DataFrame:
    s, c = F.col("sn"), F.col("cn")
    return rule_pairs(spark, sf).select(
        "sku_key", "item_key", F.round(R.type_adjustment(s, c), 12).alias("ajuste"))


def head_word_rule(spark: SparkSession, sf: str) -> DataFrame:
    words = T.significant_words(T.tokens(F.col("sn")))
    ok = R.head_word_ok(words, T.tokens(F.col("cn")))
    return rule_pairs(spark, sf).select("sku_key", "item_key", ok.alias("head_ok"))


def token_set_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return rule_pairs(spark, sf).select(
        "sku_key", "item_key", F.round(lexical.token_set_ratio("sn", "cn"), 6).alias("lex"))


def search_columns(spark: SparkSession, sf: str) -> DataFrame:
    docs = star.search_columns(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return docs.select("doc_id", F.col("descricao_norm"), F.size("descricao_fts").cast("bigint").alias("n_tokens"),
                       F.array_join(F.array_sort("descricao_fts"), " ").alias("tokens"))


def token_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = star.search_columns(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return search.token_search(docs, "Thé with, AND").select(
        "doc_id", F.col("acertos").cast("bigint").alias("acertos"))


def trigram_search(spark: SparkSession, sf: str) -> DataFrame:
    items = star.search_columns(X.raw_items(spark, sf))
    return search.trigram_search(items, "Disjuntor tripolar 20 A blue gear").select(
        "item_key", F.round("semelhanca", 6).alias("semelhanca"))


def trigram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Product texts of all parts against item descriptions of the same brand."""
    brand = table(spark, sf, "part").select("p_partkey", "p_brand")
    phrases = X.raw_products(spark, sf).join(brand, F.col("sku_key") == F.col("p_partkey"))
    items = X.raw_items(spark, sf).withColumn("p_brand", F.col("unidade"))
    return search.trigram_join(phrases, items, "sku_key", "item_key", "produto", by=["p_brand"]).select(
        "sku_key", "item_key", F.round("semelhanca", 6).alias("semelhanca"))


def token_search_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every second to fourth word of the benchmark's items as a query against all documents."""
    words = F.slice(F.split("text", " "), 2, 3)
    queries = table(spark, sf, "benchmark").select("item_id", F.array_join(words, " ").alias("consulta"))
    return search.token_search_join(queries, table(spark, sf, "documents"), "item_id", "doc_id", 10,
                                    text="text").select(
        "item_id", "doc_id", F.round("peso", 9).alias("peso"), "posto")


QUERIES = {f.__name__: f for f in (
    normalize_text, normalize_text_v1, normalize_products, tokenize, strip_codes, extract_measures,
    plate_standardize, attribute_extract, measure_hit, type_rules, head_word_rule, token_set_ratio,
    search_columns, token_search, trigram_search, trigram_join, token_search_join)}

DOCS_SQL = X.norm_stages("documents", "doc", "text")
PAIRS_SQL = f"""{X.PRODUCT_SQL},
pairs AS (SELECT DISTINCT l_partkey AS sku_key, l_suppkey AS item_key FROM lineitem),
texts AS (SELECT pairs.*, sku.n AS sn, item.n AS cn FROM pairs JOIN sku USING (sku_key)
          JOIN item USING (item_key))"""
FTS = r"list_distinct(list_filter(regexp_split_to_array({0}, '[^\p{{L}}\p{{N}}]+'), lambda t: t <> ''))"
# `a+b POSTOS` for single digits: there is one form per name, so one replacement is enough.
GANGS_SQL = r"""CASE WHEN regexp_matches(u, '\d\s*\+\s*\d\s*POSTOS?') THEN regexp_replace(u,
  '\d\s*\+\s*\d\s*POSTOS?', (regexp_extract(u, '(\d)\s*\+\s*(\d)\s*POSTOS?', 1)::INT
  + regexp_extract(u, '(\d)\s*\+\s*(\d)\s*POSTOS?', 2)::INT)::VARCHAR || ' POSTOS') ELSE u END"""
GRAMS = r"""list_distinct(flatten(list_transform(list_filter(
  regexp_split_to_array({0}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> ''),
  lambda w: list_transform(range(1, len(w) + 2), lambda i: substring('  ' || w || ' ', i::INT, 3)))))"""



def lex_stages(source: str, left: str, right: str) -> str:
    """CTEs up to lx: `source` with `lex`, the token-set similarity of two of its columns.

    The longest common subsequence of the rests is folded over the letters of one with the places of
    the other as bits of a 128-bit number, so rests are shorter than 127.
    """
    tokens = "list_distinct(list_filter(string_split({0}, ' '), lambda t: t <> ''))"
    return f"""
lx1 AS (SELECT *, {tokens.format(left)} AS ta, {tokens.format(right)} AS tb FROM {source}),
lx2 AS (SELECT *, array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS s,
    array_to_string(list_sort(list_filter(ta, lambda w: NOT list_contains(tb, w))), ' ') AS x,
    array_to_string(list_sort(list_filter(tb, lambda w: NOT list_contains(ta, w))), ' ') AS y FROM lx1),
lxm AS (SELECT x, map_from_entries(list_transform(list_distinct(string_split(x, '')), lambda c: (c,
    list_sum(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN x[i] = c
      THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END))::HUGEINT))) AS bits
  FROM (SELECT DISTINCT x FROM lx2 WHERE x <> '')),
lx3 AS (SELECT lx2.*, (1::HUGEINT << len(lx2.x)::INT) - 1 AS ones, list_transform(string_split(y, ''),
    lambda c: coalesce(bits[c], 0)::HUGEINT) AS places FROM lx2 LEFT JOIN lxm ON lx2.x = lxm.x),
lx4 AS (SELECT *, len(x) - bit_count(list_reduce(list_prepend(ones, places),
    lambda z, h: ((z + (z & h)) | (z - (z & h))) & ones)) AS l FROM lx3),
lx AS (SELECT * EXCLUDE (ta, tb, s, x, y, ones, places, l), CASE
  WHEN len(ta) = 0 OR len(tb) = 0 THEN 0::DOUBLE
  WHEN s <> '' AND (x = '' OR y = '') THEN 1::DOUBLE
  WHEN s <> '' THEN greatest(2.0::DOUBLE * (len(s) + 1 + l) / (2 * len(s) + 2 + len(x) + len(y)),
    2.0::DOUBLE * len(s) / (2 * len(s) + 1 + len(x)), 2.0::DOUBLE * len(s) / (2 * len(s) + 1 + len(y)))
  ELSE 2.0::DOUBLE * l / (len(x) + len(y)) END AS lex FROM lx4)"""


ORACLES = {
    "token_set_ratio": f"""WITH {PAIRS_SQL}, {lex_stages('texts', 'sn', 'cn')}
SELECT sku_key, item_key, round(lex, 6) AS lex FROM lx""",
    "normalize_text": f"WITH {DOCS_SQL} SELECT doc_id, n FROM doc",
    "normalize_text_v1": f"""WITH raw AS (SELECT p_partkey AS sku_key, {X.case(X.SKU_FORMS)} AS produto FROM part),
{X.norm_stages('raw', 'v1', 'produto', T.SYNONYMS_V1)} SELECT sku_key, n FROM v1""",
    "normalize_products": f"""WITH {X.PRODUCT_SQL}
SELECT sku_key, sku.n, item.n AS item_n FROM sku JOIN item ON sku_key = item_key""",
    "tokenize": f"""WITH {DOCS_SQL}, t AS (SELECT doc_id, {X.tokens_sql('n')} AS t FROM doc)
SELECT doc_id, array_to_string(t, ' ') AS tokens, array_to_string({X.words_sql('t')}, ' ') AS palavras FROM t""",
    "strip_codes": f"WITH {DOCS_SQL} SELECT doc_id, {X.codes_sql('n')} AS n FROM doc",
    "extract_measures": f"""WITH {DOCS_SQL} SELECT doc_id,
  array_to_string(list_sort(list_distinct(regexp_extract_all(n, '{T.MEASURE}'))), ' ') AS medidas,
  array_to_string(list_sort({X.numbers_sql('n')}), ' ') AS numeros FROM doc""",
    "plate_standardize": f"""
WITH r AS (SELECT p_partkey AS sku_key, upper(regexp_replace(strip_accents({X.case(X.SKU_FORMS)}),
  '[^\\x00-\\x7F]', '', 'g')) AS u FROM part), g AS (SELECT sku_key, {GANGS_SQL} AS u FROM r)
SELECT sku_key, {X.plate_sql('u')} AS n FROM g""",
    "attribute_extract": rf"""WITH {X.PRODUCT_SQL}
SELECT sku_key, {X.poles_sql('n')} AS polos, {X.gangs_sql('n')} AS postos, {X.size_sql('n')} AS tamanho,
  array_to_string(list_transform(regexp_extract_all(n, '(?:^|[^\d.])(\d+(?:\.\d+)?)\s*A\b', 1),
    lambda a: printf('%.2f', a::DOUBLE)), ' ') AS amperes FROM sku""",
    "measure_hit": f"""WITH {PAIRS_SQL}, h AS (SELECT sku_key, item_key, {X.asked_sql('sn')} AS a,
  {X.numbers_sql('cn')} AS o FROM texts)
SELECT sku_key, item_key, round({X.hit_sql('a', 'o')}, 6) AS hit FROM h""",
    "type_rules": f"""WITH {PAIRS_SQL} SELECT sku_key, item_key,
  round({X.adjustment_sql('sn', 'cn')}, 12) AS ajuste FROM texts""",
    "head_word_rule": f"""WITH {PAIRS_SQL}, h AS (SELECT sku_key, item_key,
  {X.words_sql(X.tokens_sql('sn'))}[1] AS head, {X.tokens_sql('cn')}[1:3] AS lead FROM texts)
SELECT sku_key, item_key, head IS NULL OR list_contains(lead, head) AS head_ok FROM h""",
    "search_columns": f"""WITH d AS (SELECT doc_id, strip_accents(lower(text)) AS descricao_norm FROM documents),
t AS (SELECT *, {FTS.format('descricao_norm')} AS t FROM d)
SELECT doc_id, descricao_norm, len(t) AS n_tokens, array_to_string(list_sort(t), ' ') AS tokens FROM t""",
    "token_search": f"""WITH t AS (SELECT doc_id, {FTS.format('strip_accents(lower(text))')} AS t FROM documents)
SELECT doc_id, 3::BIGINT AS acertos FROM t WHERE list_has_all(t, ['the', 'with', 'and'])""",
    "trigram_search": f"""
WITH i AS (SELECT p_partkey AS item_key, strip_accents(lower({X.case(X.ITEM_FORMS)})) AS d FROM part),
g AS (SELECT item_key, {GRAMS.format('d')} AS g FROM i),
q AS (SELECT {GRAMS.format("'disjuntor tripolar 20 a blue gear'")} AS q),
s AS (SELECT item_key, len(list_intersect(g, q))::DOUBLE / len(list_distinct(g || q)) AS semelhanca FROM g, q)
SELECT item_key, round(semelhanca, 6) AS semelhanca FROM s WHERE semelhanca >= 0.3""",
    "trigram_join": f"""
WITH i AS (SELECT p_partkey AS item_key, p_brand, strip_accents(lower({X.case(X.ITEM_FORMS)})) AS d FROM part),
s AS (SELECT p_partkey AS sku_key, p_brand, strip_accents(lower({X.case(X.SKU_FORMS)})) AS d FROM part),
ig AS (SELECT item_key, p_brand, {GRAMS.format('d')} AS g FROM i),
sg AS (SELECT sku_key, p_brand, {GRAMS.format('d')} AS q FROM s),
p AS (SELECT sku_key, item_key, len(q) AS a, len(g) AS b, len(list_intersect(g, q)) AS c FROM sg JOIN ig USING (p_brand))
SELECT sku_key, item_key, round(c::DOUBLE / (a + b - c), 6) AS semelhanca FROM p WHERE c::DOUBLE / (a + b - c) >= 0.3""",
    "token_search_join": f"""
WITH t AS (SELECT doc_id, {FTS.format('strip_accents(lower(text))')} AS t FROM documents),
q AS (SELECT item_id, {FTS.format("strip_accents(lower(array_to_string(string_split(text, ' ')[2:4], ' ')))")} AS q FROM benchmark),
f AS (SELECT item_id, doc_id, round(len(q)::DOUBLE / len(t), 9) AS peso, row_number() OVER (
  PARTITION BY item_id ORDER BY len(q)::DOUBLE / len(t) DESC, doc_id) AS posto FROM q JOIN t ON len(q) > 0 AND list_has_all(t, q))
SELECT item_id, doc_id, peso, posto::INT AS posto FROM f WHERE posto <= 10""",
}
