"""Processed months: listing, loading, metadata, round trips, arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obralake.session import scratch_path
from obralake.sources import tables as S
from obralake.streaming.arrivals import load_arrivals, start_table

from .common import month, table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", month("o_orderdate").alias("referencia"))


def _processed(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "processed")
    S.write_table(_orders(spark, sf), path)
    return path


def list_references(spark: SparkSession, sf: str) -> DataFrame:
    return S.list_references(spark, _processed(spark, sf))


def load_reference(spark: SparkSession, sf: str) -> DataFrame:
    path = _processed(spark, sf)
    return S.read_reference(spark, path, "1998-02", schema=_orders(spark, sf).schema)


def latest_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Months with an order of priority 5-LOW worth over 400000 count as valid archives."""
    orders = table(spark, sf, "orders")
    good = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") > 400000)
    manifest = orders.groupBy(month("o_orderdate").alias("referencia")).agg(
        F.bool_or(good).alias("valido"))
    return S.latest_reference(manifest, "2001-12-15")


def metadata_summary(spark: SparkSession, sf: str) -> DataFrame:
    stored = spark.read.parquet(_processed(spark, sf))
    summary = S.metadata_summary(S.file_metadata(stored))
    first = F.col("files")[0]
    return summary.select(
        "referencia", "rows", first["extension"].alias("extension"), first["columns"].alias("columns"),
        F.forall("files", lambda f: f["size_mb"] > 0).alias("tem_tamanho"))


def write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows written as JSON, CSV and Parquet with a map column, and read back."""
    rows = _orders(spark, sf).withColumn("precos", F.create_map("o_orderstatus", "o_totalprice"))
    base = scratch_path(spark, "formats")
    outcome = S.write_formats(rows, base, ("json", "csv", "parquet"))
    parts = []
    for fmt, result in outcome.items():
        reader = spark.read.format(fmt)
        if fmt == "csv":
            schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string, precos string, referencia string"
            back = reader.option("header", True).option("escape", '"').schema(schema).load(
                f"{base}/{fmt}").withColumn("precos", F.from_json("precos", "map<string,double>"))
        else:
            back = reader.schema(rows.schema).load(f"{base}/{fmt}")
        parts.append(back.select(
            F.lit(fmt).alias("formato"), "referencia", "o_orderkey",
            F.col("precos")[F.col("o_orderstatus")].alias("valor"), F.lit(result).alias("resultado")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Orders arrive in two calls, the first with two files that share orders; the later file of an
    order replaces it, within a call and after it."""
    rows = _orders(spark, sf)
    source, target, marks = (scratch_path(spark, n) for n in ("arrivals", "stored", "marks"))
    schema = rows.schema
    start_table(spark, target, schema)
    old = F.col("referencia") < "1998-06"
    rows.filter(old).withColumn("o_totalprice", F.lit(0.0)).write.parquet(f"{source}/a")
    rows.filter(F.col("o_orderkey") % 2 == 0).write.parquet(f"{source}/b")
    load_arrivals(spark, f"{source}/*", schema, target, ["referencia", "o_orderkey"], marks)
    rows.filter(F.col("o_orderkey") % 2 == 1).write.parquet(f"{source}/c")
    load_arrivals(spark, f"{source}/*", schema, target, ["referencia", "o_orderkey"], marks)
    return spark.read.schema(schema).parquet(target)


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """A month in four files, two files beside them that are none: the others' rows, and a report row each."""
    path, schema = scratch_path(spark, "processed"), _orders(spark, sf).schema
    _orders(spark, sf).filter("referencia = '1998-02'").repartition(4).write.partitionBy("referencia").parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, content in (("cut.parquet", b"PAR1 and no more"), ("other.parquet", b"{}")):
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/referencia=1998-02/{name}")
        out = at.getFileSystem(conf).create(at)
        out.write(bytearray(content))
        out.close()
    rows, report = S.read_reference_safely(spark, path, "1998-02", schema)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    return rows.select("o_orderkey", "o_totalprice", "referencia", F.lit(None).cast("string").alias("arquivo")).unionByName(
        report.select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"),
                      F.lit("1998-02").alias("referencia"), name.alias("arquivo")))


QUERIES = {f.__name__: f for f in (
    quarantine, list_references, load_reference, latest_reference, metadata_summary, write_roundtrip,
    incremental_load)}

MONTHS = "strftime(o_orderdate, '%Y-%m')"
ORACLES = {
    "quarantine": f"""SELECT o_orderkey, o_totalprice, {MONTHS} AS referencia, NULL::VARCHAR AS arquivo
FROM orders WHERE {MONTHS} = '1998-02'
UNION ALL SELECT NULL, NULL, '1998-02', unnest(['cut.parquet', 'other.parquet'])""",
    "list_references": f"SELECT DISTINCT {MONTHS} AS referencia FROM orders",
    "load_reference": f"""SELECT o_orderkey, o_totalprice, o_orderstatus, {MONTHS} AS referencia
FROM orders WHERE {MONTHS} = '1998-02'""",
    "latest_reference": f"""SELECT max({MONTHS}) AS referencia FROM orders
WHERE o_orderpriority = '5-LOW' AND o_totalprice > 400000
  AND o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2002-01-01'""",
    "metadata_summary": f"""SELECT {MONTHS} AS referencia, count(*) AS rows, '.parquet' AS extension,
  'o_orderkey,o_totalprice,o_orderstatus,referencia' AS columns, true AS tem_tamanho
FROM orders GROUP BY ALL""",
    "write_roundtrip": f"""SELECT f AS formato, {MONTHS} AS referencia, o_orderkey, o_totalprice AS valor,
  'ok' AS resultado FROM orders, (SELECT unnest(['json', 'csv', 'parquet']) AS f)""",
    "incremental_load": f"""SELECT o_orderkey, o_totalprice, o_orderstatus, {MONTHS} AS referencia
FROM orders""",
}
