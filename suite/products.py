"""Product and catalogue texts that Spark derives from the parts, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.functions import text as T

from .common import table

# Text pieces around (size, name, key) per part type; the last entry is for all other types.
SKU_FORMS = {
    "ECONOMY": "'DISJ BIPOLAR ' || p_size || ' A ' || p_name || ' 7390' || p_partkey",
    "LARGE": "'FlexSil carretel cabo 750 V ' || p_size || ',50 ' || p_name || ' Ocre 00071.' || p_partkey",
    "MEDIUM": "'PLACA 2+' || p_size || ' POSTOS 4\" X 2\" ' || p_name || ' PLUS'",
    "PROMO": "'Módulo tom 2P+T ' || p_size || ' A 1M ' || p_name || ' PVM' || p_partkey || 'QT'",
    "SMALL": "'KIT caixa de embutir vertical ' || p_size || ',00mm² ' || p_name",
    None: "'Placa cega 4x4 ' || p_name || ' tripolar ' || p_size || '0,00 kg'",
}
ITEM_FORMS = {
    "ECONOMY": "'DISJUNTOR TRIPOLAR, CORRENTE DE ' || p_size || ' A ' || p_name",
    "LARGE": "'CABO FLEXÍVEL DE 1 CONDUTOR, COBRE NU, ATÉ 750 V, BITOLA ' || p_size || ',5 MM2 ' || p_name",
    "MEDIUM": "'ESPELHO / PLACA DE ' || p_size || ' POSTOS 4\" X 4\", ' || p_name",
    "PROMO": "'TOMADA 2P+T ' || p_size || 'A, 250V (APENAS MÓDULO) ' || p_name",
    "SMALL": "'CAIXA DE SOBREPOR HORIZONTAL ' || p_size || ' MM ' || p_name",
    None: "'ESPELHO / PLACA CEGA 4\" X 4\" BIPOLAR ' || p_name || ' ' || p_size || ' KG'",
}


def case(forms: dict) -> str:
    whens = " ".join(f"WHEN '{t}' THEN {e}" for t, e in forms.items() if t)
    return f"CASE p_type {whens} ELSE {forms[None]} END"


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("sku_key"), F.expr(case(SKU_FORMS)).alias("produto"))


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_key"), F.expr(case(ITEM_FORMS)).alias("descricao"),
        F.col("p_brand").alias("unidade"), F.col("p_retailprice").alias("preco"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return raw_products(spark, sf).withColumn("n", T.product_text(F.col("produto")))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return raw_items(spark, sf).withColumn("n", T.product_text(F.col("descricao")))


# ------------------------------------------------------------------ SQL twins

def swap(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"


def norm_stages(source: str, cte: str, text: str, synonyms=T.SYNONYMS) -> str:
    """CTEs {cte}_a … {cte} that add the normalised text `n` to the rows of `source`.

    DuckDB has no look-ahead, so `not followed by a digit` is written with the next character.
    """
    s = f"upper(regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g'))"
    for pattern, word in synonyms:
        s = swap(s, pattern, word)
    s = swap(s, r"(\d),(\d)", r"\1.\2")
    s = swap(s, r"(\d+)\.0+($|[^0-9])", r"\1\2")
    s = swap(s, r"(\d+\.\d*?)0+($|[^0-9])", r"\1\2")
    cable = swap("replace(replace(s, 'CARRETEL', ''), 'FLEXSIL', 'CABO COBRE FLEXIVEL')",
                 r"750\s*V\s+(\d+(?:\.\d+)?)\b", r"750V \1MM2")
    t = swap("t", rf"(\d)\s*({T.UNIT})\b", r"\1\2")
    t = swap(t, r'[^A-Z0-9."/ ]', " ")
    t = f"trim({swap(t, ' +', ' ')}, ' ')"
    return f"""
{cte}_a AS (SELECT *, {s} AS s FROM {source}),
{cte}_b AS (SELECT *, CASE WHEN contains(s, 'FLEXSIL') OR contains(s, 'CARRETEL CABO')
                      THEN {cable} ELSE s END AS t FROM {cte}_a),
{cte} AS (SELECT * EXCLUDE (s, t), {t} AS n FROM {cte}_b)"""


def plate_sql(expr: str) -> str:
    """Plate sizes without look-ahead: forms that must stay are masked first."""
    after = r"(?:[\d.]|\s*(?:MM|CM))"
    s = swap(expr, rf'\b4"?\s*X\s*([24])("{after})', r"4¤\1\2")
    s = swap(s, rf'\b(4"?\s*)X(\s*[24])({after})', r"\1¤\2\3")
    s = swap(s, r'\b4"?\s*X\s*([24])"?', r"4X\1")
    return swap(f"replace({s}, '¤', 'X')", r"\b1M\b", " ")


PRODUCT_SQL = f"""
raw_sku AS (SELECT p_partkey AS sku_key, {case(SKU_FORMS)} AS produto FROM part),
raw_item AS (SELECT p_partkey AS item_key, {case(ITEM_FORMS)} AS descricao, p_brand AS unidade,
             p_retailprice AS preco FROM part),
{norm_stages('raw_sku', 'sku_n', 'produto')}, {norm_stages('raw_item', 'item_n', 'descricao')},
sku AS (SELECT * REPLACE ({plate_sql('n')} AS n) FROM sku_n),
item AS (SELECT * REPLACE ({plate_sql('n')} AS n) FROM item_n)"""


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def tokens_sql(n: str, stop=T.STOP_WORDS) -> str:
    return (f"list_filter(string_split(trim({swap(n, ' +', ' ')}, ' '), ' '), "
            f"lambda x: x <> '' AND x NOT IN ({quoted(stop)}))")


def words_sql(tokens: str, noise=T.NOISE_WORDS) -> str:
    return (f"list_filter({tokens}, lambda x: regexp_full_match(x, '[A-Z]{{3,}}') "
            f"AND x NOT IN ({quoted(noise)}))")


def numbers_sql(n: str) -> str:
    """Numbers not preceded by a digit or a point: the head of each run of digits and points."""
    return (f"list_distinct(list_filter(list_transform(regexp_extract_all({n}, '[0-9.]+'), "
            r"lambda r: regexp_extract(r, '^\d+(?:\.\d+)?')), lambda v: v <> ''))")


def codes_sql(n: str) -> str:
    return f"trim({swap(swap(n, T.CATALOGUE_CODE, ' '), ' +', ' ')}, ' ')"


def hit_sql(asked: str, offered: str) -> str:
    return (f"CASE WHEN len({asked}) > 0 THEN "
            f"len(list_filter({asked}, lambda x: list_contains({offered}, x)))::DOUBLE / len({asked}) END")


def asked_sql(n: str) -> str:
    return f"list_filter({numbers_sql(codes_sql(n))}, lambda x: x NOT IN ('750', '1'))"


def poles_sql(n: str) -> str:
    whens = " ".join(f"WHEN contains({n}, '{w}') THEN {v}" for w, v in T.POLE_WORDS)
    return rf"CASE {whens} ELSE try_cast(regexp_extract({n}, '\b(\d) POLOS\b', 1) AS INT) END"


def gangs_sql(n: str) -> str:
    return (rf"CASE WHEN contains({n}, 'CEGA') THEN 0 "
            rf"ELSE try_cast(regexp_extract({n}, '\b(\d)\s*POSTOS?\b', 1) AS INT) END")


def size_sql(n: str) -> str:
    return rf"nullif(regexp_extract({n}, '\b(4X2|4X4)\b', 1), '')"


def adjustment_sql(s: str, c: str) -> str:
    """Product of the type and antonym penalties for texts s (product) and c (item)."""
    def has(t, w):
        return f"contains({t}, '{w}')"

    def cut(cond, penalty):
        return f"(CASE WHEN {cond} THEN {penalty}::DOUBLE ELSE 1::DOUBLE END)"

    from obralake.functions.rules import ANTONYMS
    plate_s = f"({has(s, 'PLACA')} OR {has(s, 'ESPELHO')})"
    plate_c = f"({has(c, 'PLACA')} OR {has(c, 'ESPELHO')})"
    parts = [cut(f"({has(s, a)} AND {has(c, b)} AND NOT {has(c, a)}) OR "
                 f"({has(s, b)} AND {has(c, a)} AND NOT {has(c, b)})", 0.55) for a, b in ANTONYMS]
    parts.append(cut(f"starts_with({s}, 'KIT ') AND NOT starts_with({c}, 'KIT')", 0.7))
    ps, pc = poles_sql(s), poles_sql(c)
    parts += [
        cut(f"({ps}) > 0 AND ({pc}) > 0 AND ({ps}) <> ({pc})", 0.5),
        cut(f"{has(s, 'DISJUNTOR')} AND ({has(c, 'DISPOSITIVO DR')} OR {has(c, 'CONTATOR')})", 0.5),
        cut(f"{plate_s} AND {plate_c} AND ({gangs_sql(s)}) <> ({gangs_sql(c)})", 0.45),
        cut(f"{plate_s} AND {plate_c} AND {size_sql(s)} <> {size_sql(c)}", 0.6),
        cut(f"{plate_s} AND NOT {plate_c}", 0.5),
        cut(rf"regexp_matches({s}, '\bMODULO\b') AND {has(c, 'CONJUNTO MONTADO')}", 0.9),
        cut(rf"regexp_matches({s}, '\bCABO\b') AND try_cast(regexp_extract({s}, '\b(\d)X\d', 1) AS INT) > 1"
            f" AND {has(c, '1 CONDUTOR')}", 0.35)]
    return " * ".join(parts)
