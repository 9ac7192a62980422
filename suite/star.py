"""Relational load: dimensions, facts, edges, upserts, removal, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.operators import picks
from obralake.operators import quality as Q
from obralake.operators import removal
from obralake.operators import star
from obralake.session import store

from .common import SALES_SQL, exact_sum, sales, table


def first_wins_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of one type before all others; first row per (name, brand) gives the rest."""
    part = table(spark, sf, "part")
    both = picks.union_by_priority(part.filter("p_type = 'SMALL'"), part.filter("p_type <> 'SMALL'"))
    return picks.first_wins(both, ["p_name", "p_brand"], ["rank", "p_partkey"]).drop("rank")


def last_wins_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "props")
    return picks.last_wins(events, ["user_id", "event_type"], ["event_id"])


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return picks.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _months(spark: SparkSession, sf: str) -> DataFrame:
    return sales_months(table(spark, sf, "orders"))


def sales_months(orders: DataFrame) -> DataFrame:
    return orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("referencia"),
                         F.to_date("o_orderdate").alias("data_publicacao"))


def dim_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Months with large orders are stored already; the others are created."""
    orders = table(spark, sf, "orders")
    stored = star.dim_reference(sales_months(orders.filter("o_totalprice > 499000")))
    return star.dim_reference(sales_months(orders), stored)


def _records(spark: SparkSession, sf: str, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Part sales of a month as item records, one side per regime; `stored` if many tables are made of all their columns."""
    s = sales(spark, sf).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = s.groupBy("mes", "l_linestatus", "p_partkey", "p_size", "p_type", "p_name", "p_brand",
                     "uf").agg(exact_sum("l_extendedprice").cast("double").alias("custo"))
    nested = rows.groupBy("mes", "l_linestatus", "p_partkey", "p_size", "p_type", "p_name",
                          "p_brand").agg(F.map_from_entries(F.collect_list(
                              F.struct("uf", "custo"))).alias("precos"))
    records = nested.select(
        F.col("mes").alias("referencia"), F.col("p_size").alias("codigo"),
        F.col("p_brand").alias("unidade"), F.col("p_type").alias("categoria"),
        F.col("p_name").alias("descricao"), F.col("p_partkey").alias("seq"), "precos", "l_linestatus")
    if stored:
        records = store(records, "records")
    return (records.filter("l_linestatus = 'F'").drop("l_linestatus"),
            records.filter("l_linestatus = 'O'").drop("l_linestatus"))


def _stored_entities(records: DataFrame) -> DataFrame:
    """Entities that were there before: those of one category."""
    old = records.filter("categoria = 'PROMO'")
    return star.dim_entities(old, old, "insumo")


def _shown(entities: DataFrame) -> DataFrame:
    return entities.withColumn("descricao_fts", F.array_join("descricao_fts", " "))


def dim_entities(spark: SparkSession, sf: str) -> DataFrame:
    sem, com = _records(spark, sf)
    return _shown(star.dim_entities(sem, com, "insumo", _stored_entities(com)))


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    sem, com = _records(spark, sf)
    both = sem.unionByName(com)
    stored = _stored_entities(com)
    return star.load_summary(both, stored, star.ENTITY_KEY, ["referencia"])


def star_load(spark: SparkSession, sf: str) -> DataFrame:
    """Item cost facts of every month with their entity's description."""
    sem, com = _records(spark, sf)
    facts = star.fact_costs(sem, com, "insumo", "precos")
    items = star.dim_entities(sem, com, "insumo")
    return facts.join(items.select("id", "codigo", "unidade", "descricao"), "id")


def fact_key_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Facts that find a stored entity by (referencia, codigo, unidade)."""
    sem, com = _records(spark, sf)
    facts = sem.select(*star.ENTITY_KEY, "seq", F.explode("precos").alias("uf", "custo"))
    return star.resolve_facts(facts, _stored_entities(com)).drop("seq").groupBy(
        "referencia", "id", "uf").agg(exact_sum("custo").cast("double").alias("custo"),
                                      F.count("*").alias("n"))


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_shipdate")
    cut = F.lit("1998-06-01").cast("timestamp")
    return lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_quantity"]


def new_keys_anti(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _halves(spark, sf)
    return picks.new_keys(incoming, stored, LINE_KEY)


def existing_keys(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _halves(spark, sf)
    return picks.existing_keys(stored, incoming, LINE_KEY)


def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _halves(spark, sf)
    once = picks.last_wins(stored, LINE_KEY, LINE_ORDER)
    return picks.upsert(once, incoming, LINE_KEY, LINE_ORDER)


def edge_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as compositions made of parts and of other suppliers."""
    ref = F.lit("unica").alias("referencia")
    part, supplier = table(spark, sf, "part"), table(spark, sf, "supplier")
    items = part.select(ref, F.col("p_partkey").cast("int").alias("codigo"),
                        F.col("p_brand").alias("unidade")).withColumn(
        "id", star.entity_id("insumo"))
    comps = supplier.select(ref, F.col("s_suppkey").cast("int").alias("codigo"),
                            F.lit("UN").alias("unidade")).withColumn(
        "id", star.entity_id("composicao"))
    lines = table(spark, sf, "lineitem").join(
        part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").select(
        ref, F.col("l_suppkey").alias("codigo_pai"), F.lit(" UN ").alias("unidade_pai"),
        F.when(F.col("l_linestatus") == "O", "insumo").when(
            F.col("l_returnflag") == "A", "SERVICO").otherwise(" Composicao ").alias("tipo"),
        F.col("l_partkey").alias("codigo_filho"),
        F.when(F.col("l_linestatus") == "O", F.col("p_brand")).when(
            F.col("l_returnflag") == "N", "").otherwise("UN").alias("unidade"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("coeficiente"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice").alias("seq"))
    return star.edges(lines, items, comps)


def _family(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in ("nation", "customer", "orders", "lineitem")}


CHAIN = [("customer", "c_nationkey", "nation", "n_nationkey"),
         ("orders", "o_custkey", "customer", "c_custkey"),
         ("lineitem", "l_orderkey", "orders", "o_orderkey")]


def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Line items left after one nation goes with its customers and their orders."""
    tables = _family(spark, sf)
    gone = tables["nation"].filter("n_name = 'NATION_7'")
    kept = removal.cascade(tables, {"nation": gone}, CHAIN)
    return kept["lineitem"].groupBy("l_orderkey").agg(
        F.count("*").alias("n"), exact_sum("l_extendedprice").cast("double").alias("total"))


def remove_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left in each star table after one month is removed."""
    sem, com = _records(spark, sf, stored=True)
    refs = star.dim_reference(_months(spark, sf))
    items = star.dim_entities(sem, com, "insumo")
    comps = star.dim_entities(sem, com, "composicao")
    lines = sem.select("referencia", F.col("codigo").alias("codigo_pai"),
                       F.col("unidade").alias("unidade_pai"), F.lit("INSUMO").alias("tipo"),
                       F.col("codigo").alias("codigo_filho"), "unidade",
                       F.col("seq").cast("double").alias("coeficiente"), "seq")
    tables = {
        "referencias": refs, "insumos": items.drop("descricao_fts"),
        "composicoes": comps.drop("descricao_fts"),
        "insumo_custos": star.fact_costs(sem, com, "insumo", "precos"),
        "composicao_custos": star.fact_costs(sem, com, "composicao", "precos"),
        "composicao_analitico": star.edges(lines, items, comps)}
    kept = removal.remove_reference(tables, "1997-03")
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("tabela"), "n")
              for t, df in kept.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items without a finished order."""
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return Q.orphans(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"),
                     done, "l_orderkey", "o_orderkey")


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Row checks over line items seen as edges; some are broken on purpose by their flags."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "INSUMO").when(
            F.col("l_returnflag") == "A", "OUTRO").otherwise("COMPOSICAO").alias("tipo_componente"),
        F.when(F.col("l_tax") < 0.05, F.col("l_partkey")).alias("insumo_id"),
        F.when(F.col("l_discount") > 0.05, F.col("l_suppkey")).alias("composicao_filha_id"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("coeficiente"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("tipo_desoneracao"))
    return Q.report(lines, {
        **Q.not_null(["coeficiente", "tipo_desoneracao"]),
        **Q.outside("tipo_componente", ["INSUMO", "COMPOSICAO"]),
        **Q.outside("tipo_desoneracao", ["N", "SEM"]), **Q.one_child()})


def ids_by_reference(spark: SparkSession, sf: str) -> DataFrame:
    sem, com = _records(spark, sf)
    return star.dim_entities(sem, com, "insumo").filter(
        (F.col("referencia") == "1996-05") & (F.col("codigo") == 7)).select(
        "id", "codigo", "unidade", "descricao")


QUERIES = {f.__name__: f for f in (
    first_wins_dedupe, last_wins_dedupe, duplicate_keys, dim_reference, dim_entities, load_summary,
    star_load, fact_key_resolve, new_keys_anti, existing_keys, upsert_merge, edge_resolve,
    cascade_delete, remove_reference, orphan_rows, quality_report, ids_by_reference)}

RECORDS_SQL = f"""{SALES_SQL},
rec AS (SELECT mes AS referencia, p_size AS codigo, p_brand AS unidade, p_type AS categoria,
               p_name AS descricao, p_partkey AS seq, l_linestatus, uf,
               sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS custo
        FROM sales JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
KEYS = "referencia, codigo, unidade"


def _id(kind: str) -> str:
    return f"md5('{kind}|' || referencia || '|' || codigo || '|' || unidade)"


ENTITIES_SQL = f"""{RECORDS_SQL},
ent AS (SELECT {KEYS}, {_id('insumo')} AS id,
               arg_min(categoria, (CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END, seq)) AS categoria,
               arg_min(descricao, (CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END, seq)) AS descricao
        FROM rec GROUP BY {KEYS}),
old AS (SELECT {KEYS}, {_id('insumo')} AS id, arg_min(categoria, seq) AS categoria,
               arg_min(descricao, seq) AS descricao
        FROM rec WHERE l_linestatus = 'O' AND categoria = 'PROMO' GROUP BY {KEYS})"""
HALVES_SQL = """
lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey, l_shipdate FROM lineitem),
stored AS (SELECT * FROM lines WHERE l_shipdate < TIMESTAMP '1998-06-01'),
incoming AS (SELECT * FROM lines WHERE l_shipdate >= TIMESTAMP '1998-06-01')"""
LAST_LINE = """QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_quantity DESC) = 1"""

ORACLES = {
    "first_wins_dedupe": """
SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand
  ORDER BY CASE WHEN p_type = 'SMALL' THEN 0 ELSE 1 END, p_partkey) = 1""",
    "last_wins_dedupe": """
SELECT user_id, event_type, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS copias FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dim_reference": """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS referencia, o_orderdate::DATE AS d, o_totalprice FROM orders),
s AS (SELECT referencia, min(d) AS data_publicacao FROM o WHERE o_totalprice > 499000 GROUP BY ALL),
n AS (SELECT referencia, min(d) AS data_publicacao FROM o GROUP BY ALL)
SELECT md5('referencia|' || n.referencia) AS referencia_id, n.referencia,
       coalesce(s.data_publicacao, n.data_publicacao) AS data_publicacao
FROM n LEFT JOIN s USING (referencia)""",
    "dim_entities": f"""
WITH {ENTITIES_SQL}, alle AS (SELECT * FROM old UNION ALL
  SELECT * FROM ent WHERE id NOT IN (SELECT id FROM old))
SELECT *, md5('referencia|' || referencia) AS referencia_id,
       strip_accents(lower(descricao)) AS descricao_norm, descricao AS descricao_fts FROM alle""",
    "load_summary": f"""
WITH {ENTITIES_SQL}
SELECT referencia, count(*) AS total, count(*) FILTER (id NOT IN (SELECT id FROM old)) AS novos,
       count(*) FILTER (id IN (SELECT id FROM old)) AS existentes FROM ent GROUP BY referencia""",
    "star_load": f"""
WITH {ENTITIES_SQL}, f AS (SELECT {KEYS}, uf,
    CASE l_linestatus WHEN 'F' THEN 'SEM' ELSE 'COM' END AS tipo_desoneracao,
    arg_max(custo, (seq, custo)) AS custo FROM rec GROUP BY ALL)
SELECT f.referencia, ent.id, f.uf, f.tipo_desoneracao, f.custo, f.codigo, f.unidade, ent.descricao
FROM f JOIN ent USING ({KEYS})""",
    "fact_key_resolve": f"""
WITH {ENTITIES_SQL}
SELECT referencia, old.id, uf, sum(custo::DECIMAL(18,2))::DOUBLE AS custo, count(*) AS n
FROM rec JOIN old USING ({KEYS}) WHERE l_linestatus = 'F' GROUP BY ALL""",
    "new_keys_anti": f"""
WITH {HALVES_SQL} SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM stored s
  WHERE s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber)""",
    "existing_keys": f"""
WITH {HALVES_SQL} SELECT * FROM stored s WHERE EXISTS (SELECT 1 FROM incoming i
  WHERE s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber)""",
    "upsert_merge": f"""
WITH {HALVES_SQL}, a AS (SELECT * FROM stored {LAST_LINE}), b AS (SELECT * FROM incoming {LAST_LINE})
SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b
  WHERE a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)""",
    "edge_resolve": """
WITH l AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN 'INSUMO' WHEN l_returnflag = 'A' THEN 'SERVICO'
             ELSE 'COMPOSICAO' END AS tipo,
           CASE WHEN l_linestatus = 'O' THEN p_brand WHEN l_returnflag = 'N' THEN '' ELSE 'UN' END AS unidade,
           coalesce(CASE WHEN l_tax > 0 THEN l_quantity END, 0) AS coeficiente
           FROM lineitem JOIN part ON l_partkey = p_partkey),
once AS (SELECT * FROM l WHERE l_partkey <> 0 AND l_suppkey <> 0 AND tipo <> 'SERVICO' AND unidade <> ''
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, tipo, l_partkey, unidade
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, coeficiente DESC) = 1),
e AS (SELECT *, md5('composicao|unica|' || l_suppkey || '|UN') AS pai,
      md5(CASE tipo WHEN 'INSUMO' THEN 'insumo' ELSE 'composicao' END || '|unica|' || l_partkey || '|' || unidade) AS filho
      FROM once WHERE tipo = 'INSUMO' OR l_partkey IN (SELECT s_suppkey FROM supplier))
SELECT md5(pai || '|' || tipo || '|' || filho) AS id, 'unica' AS referencia, pai AS composicao_pai_id,
       tipo AS tipo_componente, CASE WHEN tipo = 'INSUMO' THEN filho END AS insumo_id,
       CASE WHEN tipo = 'COMPOSICAO' THEN filho END AS composicao_filha_id, coeficiente, unidade FROM e""",
    "cascade_delete": """
SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7') GROUP BY l_orderkey""",
    "remove_reference": f"""
WITH {ENTITIES_SQL}, k AS (SELECT * FROM ent WHERE referencia <> '1997-03'),
r AS (SELECT * FROM rec WHERE referencia <> '1997-03'),
f AS (SELECT DISTINCT {KEYS}, uf, l_linestatus FROM r)
SELECT 'referencias' AS tabela, count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS n FROM orders
WHERE strftime(o_orderdate, '%Y-%m') <> '1997-03'
UNION ALL SELECT 'insumos', count(*) FROM k UNION ALL SELECT 'composicoes', count(*) FROM k
UNION ALL SELECT 'insumo_custos', count(*) FROM f UNION ALL SELECT 'composicao_custos', count(*) FROM f
UNION ALL SELECT 'composicao_analitico', count(*) FROM (SELECT DISTINCT {KEYS} FROM r WHERE l_linestatus = 'F')""",
    "orphan_rows": """
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "quality_report": """
WITH l AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'INSUMO' WHEN l_returnflag = 'A' THEN 'OUTRO'
             ELSE 'COMPOSICAO' END AS t, l_tax < 0.05 AS i, l_discount > 0.05 AS c,
           l_quantity > 10 AS q, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS d FROM lineitem)
SELECT 'nulo:coeficiente' AS regra, count(*) FILTER (NOT q) AS violacoes FROM l
UNION ALL SELECT 'nulo:tipo_desoneracao', count(*) FILTER (d IS NULL) FROM l
UNION ALL SELECT 'dominio:tipo_componente', count(*) FILTER (t = 'OUTRO') FROM l
UNION ALL SELECT 'dominio:tipo_desoneracao', count(*) FILTER (d NOT IN ('N', 'SEM')) FROM l
UNION ALL SELECT 'filho_unico', count(*) FILTER (NOT ((t = 'INSUMO' AND i AND NOT c)
  OR (t = 'COMPOSICAO' AND c AND NOT i))) FROM l""",
    "ids_by_reference": f"""
WITH {ENTITIES_SQL} SELECT id, codigo, unidade, descricao FROM ent
WHERE referencia = '1996-05' AND codigo = 7""",
}
