"""Sheet handling: headers, wide → long, row filters, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.functions import parsing as P
from obralake.operators import compositions as C
from obralake.operators import sheets as S
from obralake.session import store

from .common import SALES_SQL, TITLE, UF_SQL, exact_sum, month, price_cells, reference_of, table

AMOUNTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def wide_to_long_positive(spark: SparkSession, sf: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by key first: a task then holds the sums of its own parts only.
    lines = table(spark, sf, "lineitem").select("l_partkey", *AMOUNTS).repartition(parts, "l_partkey")
    long = S.wide_to_long(lines, ["l_partkey"], AMOUNTS)
    return long.groupBy("l_partkey", "uf").agg(
        F.count("*").alias("n"), exact_sum("valor").cast("double").alias("total"))


def _lines(spark: SparkSession, sf: str, sheets: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    cells = store(price_cells(spark, sf, sheets), "cells")
    return cells, S.sheet_lines(cells, S.sheet_headers(cells))


def wide_to_map(spark: SparkSession, sf: str) -> DataFrame:
    _, lines = _lines(spark, sf, S.ITEM_SHEETS)
    items = S.item_records(lines, reference_of())
    pairs = F.array_sort(F.transform(F.map_entries("precos"), lambda e: F.concat(
        e["key"], F.lit("="), F.format_string("%.2f", e["value"]))))
    return items.select("referencia", "aba", "codigo", "categoria", "descricao", "unidade",
                        "origem_preco", "tipo_desoneracao",
                        F.array_join(pairs, ";").alias("precos"))


def cost_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Composition costs in long form, codes recovered from the analytic sheet."""
    cells, lines = _lines(spark, sf, (*S.COST_SHEETS, S.BOM_SHEET))
    costs = S.cost_records(lines, reference_of())
    bom = S.bom_rows(cells, reference_of())
    full = C.recover_codes(costs, bom)
    return S.map_to_long(full, ["referencia", "aba", "codigo", "descricao", "unidade",
                                "tipo_desoneracao"], "custos", "uf", "custo")


def bom_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return S.bom_rows(price_cells(spark, sf, [S.BOM_SHEET]), reference_of()).select(
        "referencia", "categoria", "codigo_composicao_mae", "tipo_item", "codigo_item_filho",
        "descricao", "unidade", "coeficiente", "situacao", "aba")


def header_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.header_rows(price_cells(spark, sf)).withColumn("start_row", S.first_data_row())


def header_column_map(spark: SparkSession, sf: str) -> DataFrame:
    cells = price_cells(spark, sf)
    return S.header_column_map(cells, store(S.header_rows(cells), "heads"))


def sheet_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Size and first lines of every sheet."""
    return S.sheet_profile(price_cells(spark, sf)).select(
        "file", "sheet", "linhas", "colunas", "celulas", "amostra")


def sheet_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first lines of every sheet."""
    return S.sheet_profile(price_cells(spark, sf)).select("file", "sheet", "amostra")


def half_even_rounding(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteenths of quantities and prices, many of which are ties in the fourth decimal."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", P.half_even(F.col("l_quantity") / 16).alias("quantidade"),
        P.half_even(F.floor("l_extendedprice") / 16).alias("preco"))


def missing_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as workbooks; an order of status F, O or P stands for one sheet each."""
    sheet = F.when(F.col("o_orderstatus") == "F", "ISD").when(
        F.col("o_orderstatus") == "O", "ICD").otherwise("CSD")
    present = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("file"), sheet.alias("sheet"))
    return S.missing_sheets(present)


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", P.clean_name(F.col("text")).alias("nome"),
                       P.safe_sheet_name(F.col("source")).alias("aba"))


def reference_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    key = P.reference_key(F.year("o_orderdate"), F.month("o_orderdate"))
    keyed = orders.select("o_orderkey", key.alias("referencia"))
    name = F.concat(F.lit("TABELA-"), "referencia", F.lit("-formato-xlsx.zip"))
    return keyed.select("o_orderkey", "referencia", P.reference_of_name(name).alias("lida"))


def regime_label(spark: SparkSession, sf: str) -> DataFrame:
    sheet = F.when(F.col("l_returnflag") == "N", "ISD").when(
        F.col("l_returnflag") == "R", "CSD").otherwise("CCD")
    return table(spark, sf, "lineitem").select(sheet.alias("aba")).groupBy(
        "aba", P.regime_label(F.col("aba")).alias("tipo"), P.regime_code(F.col("aba")).alias("sigla")
    ).agg(F.count("*").alias("n"))


def _sparse_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order attributes that are only known for some orders."""
    known = lambda cond, c: F.when(cond, F.col(c)).alias(c)
    return table(spark, sf, "orders").select(
        known(F.col("o_totalprice") > 300000, "o_custkey"),
        known(F.col("o_orderstatus") == "F", "o_orderpriority"),
        known(F.col("o_totalprice") < 50000, "o_totalprice"),
        known(F.col("o_orderkey") < 0, "o_orderstatus"))


SPARSE_SQL = """sparse AS (SELECT
  CASE WHEN o_totalprice > 300000 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_totalprice < 50000 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey < 0 THEN o_orderstatus END AS o_orderstatus FROM orders)"""


def drop_empty_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.drop_empty_rows(_sparse_orders(spark, sf)).select(
        "o_custkey", "o_orderpriority", "o_totalprice")


def drop_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    return S.drop_empty_columns(_sparse_orders(spark, sf))


def _texty(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as raw sheet lines: some titles, notes, blank units and odd codes among them."""
    code = F.when(F.col("p_size") > 45, "n/d").when(F.col("p_size") > 40, "0").when(
        F.col("p_size") > 35, F.concat(F.col("p_partkey").cast("string"), F.lit(".9"))).when(
        F.col("p_size") > 30, F.concat(F.lit("-"), F.col("p_partkey").cast("string"))).otherwise(
        F.col("p_partkey").cast("string"))
    text = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Observação: "), "p_name")).when(
        F.col("p_type") == "LARGE", " descrição ").otherwise(F.concat(F.lit("  "), "p_name"))
    unit = F.when(F.col("p_brand") == "Brand#1", "  ").when(
        F.col("p_brand") == "Brand#2", "Unidade").when(
        F.col("p_brand") != "Brand#3", F.col("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", code.alias("codigo"), text.alias("descricao"), unit.alias("unidade"))


TEXTY_SQL = """texty AS (SELECT p_partkey,
  CASE WHEN p_size > 45 THEN 'n/d' WHEN p_size > 40 THEN '0'
       WHEN p_size > 35 THEN p_partkey || '.9' WHEN p_size > 30 THEN '-' || p_partkey
       ELSE p_partkey::VARCHAR END AS codigo,
  CASE WHEN p_type = 'PROMO' THEN 'Observação: ' || p_name WHEN p_type = 'LARGE' THEN ' descrição '
       ELSE '  ' || p_name END AS descricao,
  CASE WHEN p_brand = 'Brand#1' THEN '  ' WHEN p_brand = 'Brand#2' THEN 'Unidade'
       WHEN p_brand <> 'Brand#3' THEN p_brand END AS unidade FROM part)"""


def data_row_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Which lines count as composition lines, and which as item lines."""
    rows = _texty(spark, sf)
    cost = S.cost_row_filter(F.col("descricao"), F.col("unidade"))
    item = S.item_row_filter(F.col("codigo"), F.col("descricao"))
    flagged = rows.select("p_partkey", F.coalesce(cost, F.lit(False)).alias("composicao"),
                          F.coalesce(item, F.lit(False)).alias("insumo"))
    return flagged.filter("composicao or insumo")


def numeric_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = _texty(spark, sf).withColumn("tipo", F.when(
        F.col("unidade").isNotNull(), F.when(F.col("unidade") == "Unidade", "nan").otherwise(
            F.concat(F.lit(" "), F.lower("unidade")))))
    return rows.filter(P.to_number(F.col("codigo")).isNotNull()).select(
        "p_partkey", P.to_number(F.col("codigo")).alias("numero"),
        P.to_int(F.col("codigo")).alias("inteiro"), P.positive_code(F.col("codigo")).alias("positivo"),
        P.item_type(F.col("tipo")).alias("tipo"))


def _blanked_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts as cost lines (most types lack the code, some have another unit) and as mothers."""
    part = table(spark, sf, "part")
    ref = F.lit("unica").alias("referencia")
    costs = part.select(
        ref, F.col("p_partkey").alias("seq"),
        F.when(F.col("p_type") == "PROMO", F.col("p_partkey")).cast("int").alias("codigo"),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("sem "), "p_name")).otherwise(
            F.col("p_name")).alias("descricao"),
        F.when(F.col("p_type") == "LARGE", "OUTRA").otherwise(F.col("p_brand")).alias("unidade"))
    mothers = part.filter("p_size > 10").select(
        ref, F.col("p_partkey").alias("seq"), F.lit(C.MOTHER).alias("tipo_item"),
        F.upper("p_name").alias("descricao"), F.concat(F.lit(" "), "p_brand").alias("unidade"),
        F.col("p_partkey").cast("int").alias("codigo_composicao_mae"))
    return costs, mothers


RECOVER_SQL = """
costs AS (SELECT p_partkey AS seq, CASE WHEN p_type = 'PROMO' THEN p_partkey END AS codigo,
    CASE WHEN p_type = 'SMALL' THEN 'sem ' || p_name ELSE p_name END AS descricao,
    CASE WHEN p_type = 'LARGE' THEN 'OUTRA' ELSE p_brand END AS unidade FROM part),
mothers AS (SELECT * FROM part WHERE p_size > 10),
exact AS (SELECT upper(p_name) AS d, upper(p_brand) AS u, max_by(p_partkey, p_partkey) AS c
    FROM mothers GROUP BY ALL),
loose AS (SELECT upper(p_name) AS d, max_by(p_partkey, p_partkey) AS c FROM mothers GROUP BY ALL),
recovered AS (SELECT seq, descricao, unidade,
    CASE WHEN codigo > 0 THEN codigo ELSE nullif(coalesce(exact.c, loose.c), 0) END AS codigo
    FROM costs LEFT JOIN exact ON upper(descricao) = exact.d AND upper(unidade) = exact.u
    LEFT JOIN loose ON upper(descricao) = loose.d)"""


def code_recovery(spark: SparkSession, sf: str) -> DataFrame:
    costs, mothers = _blanked_parts(spark, sf)
    return C.recover_codes(costs, mothers).select("seq", "codigo", "descricao", "unidade")


def recovery_rate(spark: SparkSession, sf: str) -> DataFrame:
    costs, mothers = _blanked_parts(spark, sf)
    return C.recovery_rate(C.recover_codes(costs, mothers), ["unidade"])


def hierarchy_nest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as mothers, their line items as children."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem")
    ref, none = F.lit("unica").alias("referencia"), F.lit(None)
    mothers = orders.filter("o_orderstatus <> 'P'").select(
        ref, F.col("o_orderkey").alias("codigo_composicao_mae"), F.lit(C.MOTHER).alias("tipo_item"),
        none.cast("bigint").alias("codigo_item_filho"), F.col("o_orderpriority").alias("categoria"),
        F.col("o_orderstatus").alias("descricao"), F.lit("UN").alias("unidade"),
        none.cast("double").alias("coeficiente"), none.cast("string").alias("situacao"),
        F.lit(0).cast("bigint").alias("seq"), F.lit(0.0).alias("seq2"))
    children = lines.select(
        ref, F.col("l_orderkey").alias("codigo_composicao_mae"),
        F.when(F.col("l_linestatus") == "O", "INSUMO").otherwise("COMPOSICAO").alias("tipo_item"),
        F.col("l_partkey").alias("codigo_item_filho"), none.cast("string").alias("categoria"),
        F.col("l_returnflag").alias("descricao"), none.cast("string").alias("unidade"),
        F.col("l_quantity").alias("coeficiente"), F.col("l_linestatus").alias("situacao"),
        F.col("l_linenumber").cast("bigint").alias("seq"), F.col("l_extendedprice").alias("seq2"))
    tree = C.nest(mothers.unionByName(children), order=("seq", "seq2"))
    shown = F.transform("componentes", lambda c: F.concat_ws(
        ":", c["tipo"], c["codigo"].cast("string"), c["descricao"], c["unidade"],
        c["coeficiente"].cast("int").cast("string"), c["situacao"]))
    return tree.select("codigo", "categoria", "descricao", "unidade", "situacao", "referencia",
                       F.array_join(shown, ";").alias("componentes"))


WS = r"\s\x0B\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NUM_SQL = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"

QUERIES = {f.__name__: f for f in (
    wide_to_long_positive, wide_to_map, cost_sheet, bom_sheet, header_rows, header_column_map,
    sheet_profile, sheet_preview, half_even_rounding, missing_sheets, clean_names, reference_key, regime_label, drop_empty_rows,
    drop_empty_columns, data_row_filter, numeric_rows, code_recovery, recovery_rate,
    hierarchy_nest)}

ORACLES = {
    "wide_to_long_positive": """
WITH u AS (UNPIVOT (SELECT l_partkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
           ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME uf VALUE valor)
SELECT l_partkey, uf, count(*) AS n, sum(valor::DECIMAL(18,2))::DOUBLE AS total
FROM u WHERE valor > 0 GROUP BY ALL""",
    "wide_to_map": f"""
WITH {SALES_SQL},
v AS (SELECT mes, CASE WHEN l_linestatus = 'F' THEN 'ISD' ELSE 'ICD' END AS aba, l_partkey, uf,
             sum(l_extendedprice::DECIMAL(18,2)) AS v FROM sales GROUP BY ALL)
SELECT mes AS referencia, aba, l_partkey::INT AS codigo, p_type AS categoria,
       p_name AS descricao, p_brand AS unidade, 'C' AS origem_preco,
       CASE WHEN aba = 'ISD' THEN 'SEM DESONERACAO' ELSE 'COM DESONERACAO' END AS tipo_desoneracao,
       coalesce(string_agg(uf || '=' || v::VARCHAR, ';' ORDER BY uf) FILTER (v > 0), '') AS precos
FROM v JOIN part ON l_partkey = p_partkey WHERE l_partkey <> 0 GROUP BY ALL""",
    "cost_sheet": f"""
WITH {SALES_SQL},
v AS (SELECT mes, CASE WHEN l_linestatus = 'F' THEN 'CSD' ELSE 'CCD' END AS aba, l_suppkey, uf,
             sum(l_quantity::DECIMAL(18,2))::DOUBLE AS custo FROM sales GROUP BY ALL)
SELECT mes AS referencia, aba, nullif(s_suppkey, 0)::INT AS codigo, s_name AS descricao,
       CASE WHEN s_nationkey < 5 THEN 'M2' ELSE 'UN' END AS unidade,
       CASE WHEN aba = 'CSD' THEN 'SEM DESONERACAO' ELSE 'COM DESONERACAO' END AS tipo_desoneracao,
       uf, custo
FROM v JOIN supplier ON l_suppkey = s_suppkey WHERE custo > 0""",
    "bom_sheet": f"""
WITH {SALES_SQL}
SELECT mes AS referencia, 'SERVICOS' AS categoria, l_suppkey::INT AS codigo_composicao_mae,
       CASE WHEN l_returnflag = 'R' THEN 'COMPOSICAO' ELSE 'INSUMO' END AS tipo_item,
       l_partkey AS codigo_item_filho, NULL::VARCHAR AS descricao, 'UN' AS unidade,
       max(l_quantity) AS coeficiente, NULL::VARCHAR AS situacao, 'Analítico' AS aba
FROM sales GROUP BY ALL
UNION ALL
SELECT DISTINCT mes, 'SERVICOS', l_suppkey::INT, 'COMPOSICAO_MAE', NULL, s_name, 'UN', NULL,
       'ATIVO', 'Analítico'
FROM sales JOIN supplier ON l_suppkey = s_suppkey""",
    "header_rows": f"""
WITH {SALES_SQL},
k AS (SELECT DISTINCT mes, l_linestatus = 'F' AS sem FROM sales)
SELECT mes || '.xlsx' AS file, CASE WHEN sem THEN 'ISD' ELSE 'ICD' END AS sheet,
       3::BIGINT AS state_row, 4::BIGINT AS place_row, 5::BIGINT AS title_row, 6::BIGINT AS start_row FROM k
UNION ALL
SELECT mes || '.xlsx', CASE WHEN sem THEN 'CSD' ELSE 'CCD' END, 3, 4, NULL, 5 FROM k""",
    "header_column_map": f"""
WITH {SALES_SQL},
k AS (SELECT DISTINCT mes, l_linestatus = 'F' AS sem FROM sales),
s AS (SELECT mes, CASE WHEN sem THEN 'ISD' ELSE 'ICD' END AS sheet FROM k
      UNION ALL SELECT mes, CASE WHEN sem THEN 'CSD' ELSE 'CCD' END FROM k)
SELECT mes || '.xlsx' AS file, sheet, (n_nationkey + 5)::INT AS col, {UF_SQL} AS uf,
       n_name AS place FROM s, nation""",
    "sheet_preview": f"""
WITH {SALES_SQL},
t AS (SELECT '{TITLE}|' || string_agg(u, '|' ORDER BY n) AS amostra FROM (
  SELECT n_nationkey AS n, {UF_SQL} AS u FROM nation)),
s AS (SELECT DISTINCT mes, l_linestatus = 'F' AS sem FROM sales)
SELECT mes || '.xlsx' AS file, unnest(CASE WHEN sem THEN ['ISD', 'CSD'] ELSE ['ICD', 'CCD'] END) AS sheet, amostra FROM s, t
UNION ALL SELECT DISTINCT mes || '.xlsx', 'Analítico', '' FROM sales""",
    "half_even_rounding": """
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 16, 3) AS quantidade,
  round_even(floor(l_extendedprice) / 16, 3) AS preco FROM lineitem""",
    "sheet_profile": f"""
WITH {SALES_SQL},
v AS (SELECT DISTINCT mes, l_linestatus = 'F' AS sem, l_partkey AS k, c_nationkey AS n, true AS item FROM sales
      UNION ALL SELECT DISTINCT mes, l_linestatus = 'F', l_suppkey, c_nationkey, false FROM sales),
r AS (SELECT mes, sem, item, k, count(*) AS vals,
             CASE WHEN item THEN 5 WHEN s_acctbal >= 3000 THEN 4 ELSE 3 END AS texts
      FROM v LEFT JOIN supplier ON NOT item AND k = s_suppkey GROUP BY ALL),
b AS (SELECT mes, l_suppkey, l_partkey, l_returnflag = 'R' AS comp FROM sales GROUP BY ALL),
bm AS (SELECT DISTINCT mes, l_suppkey FROM sales),
t AS (SELECT '{TITLE}|' || string_agg(u, '|' ORDER BY n) AS amostra FROM (
  SELECT n_nationkey AS n, {UF_SQL} AS u FROM nation))
SELECT mes || '.xlsx' AS file, CASE WHEN item THEN CASE WHEN sem THEN 'ISD' ELSE 'ICD' END
       ELSE CASE WHEN sem THEN 'CSD' ELSE 'CCD' END END AS sheet, max(k) + 10 AS linhas,
       30::BIGINT AS colunas, (sum(vals + texts) + 50 + 2 + CASE WHEN item THEN 4 ELSE 0 END)::BIGINT AS celulas,
       (SELECT amostra FROM t) AS amostra
FROM r GROUP BY mes, sem, item
UNION ALL
SELECT mes || '.xlsx', 'Analítico', max(last), 8, sum(n)::BIGINT, '' FROM (
  SELECT mes, l_suppkey * 1000000 + 10 AS last, 5 AS n FROM bm
  UNION ALL SELECT mes, l_suppkey * 1000000 + 11 + l_partkey * 2 + CASE WHEN comp THEN 1 ELSE 0 END, 6
  FROM b) GROUP BY mes""",
    "missing_sheets": """
WITH p AS (SELECT DISTINCT o_custkey AS file, CASE o_orderstatus WHEN 'F' THEN 'ISD'
             WHEN 'O' THEN 'ICD' ELSE 'CSD' END AS sheet FROM orders)
SELECT f.file, r.sheet FROM (SELECT DISTINCT file FROM p) f,
  (SELECT unnest(['ISD', 'ICD', 'CSD', 'CCD', 'Analítico']) AS sheet) r
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.file = f.file AND p.sheet = r.sheet)""",
    "clean_names": rf"""
SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(text, '^[{WS}]+|[{WS}]+$', '', 'g'),
         '[^\p{{L}}\p{{N}}_{WS}]', '', 'g'), '[{WS}]+', '_', 'g')) AS nome,
       lower(replace(regexp_replace(source, '[^\p{{L}}\p{{N}}_{WS}-]', '', 'g'), ' ', '_')) AS aba
FROM documents""",
    "reference_key": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS referencia,
       strftime(o_orderdate, '%Y-%m') AS lida FROM orders""",
    "regime_label": """
WITH s AS (SELECT CASE l_returnflag WHEN 'N' THEN 'ISD' WHEN 'R' THEN 'CSD' ELSE 'CCD' END AS aba
           FROM lineitem)
SELECT aba, CASE WHEN aba IN ('ISD', 'CSD') THEN 'SEM DESONERACAO' ELSE 'COM DESONERACAO' END AS tipo,
       CASE WHEN aba IN ('ISD', 'CSD') THEN 'SEM' ELSE 'COM' END AS sigla, count(*) AS n
FROM s GROUP BY ALL""",
    "drop_empty_rows": f"""
WITH {SPARSE_SQL} SELECT o_custkey, o_orderpriority, o_totalprice FROM sparse
WHERE coalesce(o_custkey::VARCHAR, o_orderpriority, o_totalprice::VARCHAR, o_orderstatus) IS NOT NULL""",
    "drop_empty_columns": f"WITH {SPARSE_SQL} SELECT o_custkey, o_orderpriority, o_totalprice FROM sparse",
    "data_row_filter": rf"""
WITH {TEXTY_SQL}, f AS (SELECT p_partkey,
  coalesce(descricao IS NOT NULL AND unidade IS NOT NULL AND trim(descricao) <> '' AND trim(unidade) <> ''
    AND upper(trim(descricao)) NOT IN ('DESCRIÇÃO', 'DESCRICAO', 'GRUPO')
    AND upper(trim(unidade)) <> 'UNIDADE'
    AND NOT (upper(trim(descricao)) LIKE 'OBSERVAÇÃO%' OR upper(trim(descricao)) LIKE 'OBSERVACAO%'),
    false) AS composicao,
  coalesce(regexp_matches(codigo, {NUM_SQL}) AND trunc(try_cast(codigo AS DOUBLE)) <> 0
    AND trim(descricao) <> '', false) AS insumo FROM texty)
SELECT * FROM f WHERE composicao OR insumo""",
    "numeric_rows": rf"""
WITH {TEXTY_SQL}, n AS (SELECT *, try_cast(codigo AS DOUBLE) AS numero FROM texty
                        WHERE regexp_matches(codigo, {NUM_SQL}))
SELECT p_partkey, numero, trunc(numero)::INT AS inteiro,
  CASE WHEN trunc(numero) > 0 THEN trunc(numero)::INT END AS positivo,
  CASE WHEN unidade IS NULL OR unidade = 'Unidade' THEN 'COMPOSICAO_MAE' ELSE trim(upper(unidade)) END AS tipo
FROM n""",
    "code_recovery": f"WITH {RECOVER_SQL} SELECT seq, codigo::INT AS codigo, descricao, unidade FROM recovered",
    "recovery_rate": f"""WITH {RECOVER_SQL} SELECT unidade, count(codigo) AS recuperados,
        count(*) AS total FROM recovered GROUP BY unidade""",
    "hierarchy_nest": """
WITH c AS (SELECT l_orderkey, string_agg(
    CASE WHEN l_linestatus = 'O' THEN 'INSUMO' ELSE 'COMPOSICAO' END || ':' || l_partkey || ':' ||
    l_returnflag || '::' || l_quantity::INT || ':' || l_linestatus, ';'
    ORDER BY l_linenumber, l_extendedprice,
             CASE WHEN l_linestatus = 'O' THEN 'INSUMO' ELSE 'COMPOSICAO' END, l_partkey) AS componentes
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS codigo, o_orderpriority AS categoria, o_orderstatus AS descricao,
       'UN' AS unidade, '' AS situacao, 'unica' AS referencia,
       coalesce(componentes, '') AS componentes
FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""",
}
