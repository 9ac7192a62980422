"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

import os
import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; every executor has it."""
    return public_tokenizers.path(name)


def pack_documents(spark: SparkSession, sf: str) -> DataFrame:
    from .packing import pack
    return pieces(pack(table(spark, sf, "documents"), vocabulary_file()))


def pieces(packed: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("input_ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def shard_documents(spark: SparkSession, sf: str) -> DataFrame:
    from .sharding import shard
    return shard(table(spark, sf, "documents"), 40)


def preferences(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations 2n (chosen) and 2n + 1 (rejected) are a pair."""
    from .preferences import format_preferences
    turns = table(spark, sf, "conversations").select(
        F.shiftright("conv_id", 1).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"),
        "turn", "role", "text")
    spans = lambda c: F.array_join(F.transform(
        c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return format_preferences(turns).select(
        "pair_id", "n_prompt", "prompt", "chosen", "rejected", spans("chosen_spans"),
        spans("rejected_spans"))


PREFERENCES_SQL = """
WITH t AS (SELECT conv_id >> 1 AS p, conv_id % 2 AS side, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT p, CAST(coalesce(min(i) FILTER (WHERE NOT same) - 1, count(*)) AS INT) AS n
      FROM (SELECT p, i, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same
            FROM t GROUP BY p, i) GROUP BY p),
r AS (SELECT t.*, n, i <= n AS shared, '<|' || role || '|>' || chr(10) AS head,
             head || text || '<|end|>' || chr(10) AS body FROM t JOIN n USING (p)),
s AS (SELECT *, CAST(coalesce(sum(length(body)) OVER (PARTITION BY p, side, shared ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun FROM r),
m AS (SELECT *, (begun + length(head)) || ':' || (begun + length(body)) AS span FROM s)
SELECT p AS pair_id, any_value(n) AS n_prompt,
  coalesce(string_agg(body, '' ORDER BY i) FILTER (WHERE side = 0 AND shared), '') AS prompt,
  coalesce(string_agg(body, '' ORDER BY i) FILTER (WHERE side = 0 AND NOT shared), '') AS chosen,
  coalesce(string_agg(body, '' ORDER BY i) FILTER (WHERE side = 1 AND NOT shared), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (WHERE side = 0 AND NOT shared AND role = 'assistant'), '')
    AS chosen_spans,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (WHERE side = 1 AND NOT shared AND role = 'assistant'), '')
    AS rejected_spans
FROM m GROUP BY p"""


def scan_for_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """A source is an owner; its documents of one language are a repository."""
    from .secret_scan import KINDS, scan_secrets, spans_text
    found = scan_secrets(table(spark, sf, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    number = lambda kind: F.size(F.filter(
        "secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select("doc_id", number(0), number(1), number(2),
                        F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("secrets")).alias("spans"))


def link_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    from .jaccard import link_documents
    return link_documents(table(spark, sf, "documents"), 90, 3)


def _remainder(of: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def score_toxic(spark: SparkSession, sf: str) -> DataFrame:
    from .toxicity import score_toxicity
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", (_remainder(5) == 0).alias("held_out"))
    labels = table(spark, sf, "labels").filter(_remainder(5) != 0).select("doc_id", "toxic")
    return score_toxicity(docs, labels, keep=["held_out"])


def predict_language(spark: SparkSession, sf: str) -> DataFrame:
    from .langid import identify
    docs = table(spark, sf, "documents").withColumn("held_out", _remainder(4) == 2)
    return identify(docs, docs.filter(~F.col("held_out")), keep=["held_out"])


def search_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from .mtree import top_inner_products
    rows = table(spark, sf, "embeddings")
    return top_inner_products(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


SEARCH_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * e.v[i])) AS BIGINT) AS score
      FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""


#: Key of the pseudonyms; a real run sets its own.
PSEUDONYM_KEY = os.environ.get("PSEUDONYM_KEY", "public key of the tests")


def pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    from .pseudonyms import replace_personal_data
    return replace_personal_data(table(spark, sf, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    from .decontamination import contamination
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def _words_sql(column: str) -> str:
    lower = f"translate(coalesce({column}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return (rf"list_filter(regexp_split_to_array({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), "
            "lambda x: x <> '')")


DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
i AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s + 1:s + least(len(w), 10)], ' ') AS g
      FROM (SELECT *, unnest(range(len(w) - least(len(w), 10) + 1)) AS s FROM i WHERE len(w) > 0)),
p AS (SELECT doc_id, l, p, array_to_string(w[p + 1:p + l], ' ') AS g
      FROM (SELECT d.*, l, unnest(range(greatest(len(w) - l + 1, 0))) AS p
            FROM d, (SELECT DISTINCT l FROM v))),
h AS (SELECT doc_id, item_id, p, l FROM p JOIN v USING (l, g)),
n AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS x FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, n.n IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


def resample_documents(spark: SparkSession, sf: str) -> DataFrame:
    from .resampling import weighted
    return weighted(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("key")


# The checksum is taken byte by byte from a table of 256 remainders, and only once a distinct feature.
RESAMPLE_SQL = f"""
WITH RECURSIVE step AS (SELECT b, CAST(b AS BIGINT) AS c, 0 AS i FROM range(256) t(b) UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM step WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS v FROM step WHERE i = 8),
d AS (SELECT 0 AS side, doc_id AS id, row_number() OVER () AS no, {_words_sql("text")} AS w FROM documents
      UNION ALL SELECT 1, NULL, row_number() OVER (), {_words_sql("text")} FROM benchmark),
f AS (SELECT side, no, w[i] AS g FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)
      UNION ALL SELECT side, no, w[i] || ' ' || w[i + 1] FROM (SELECT *, unnest(range(1, len(w))) AS i FROM d)),
g AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM f)),
k AS (SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2),
             lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
             lambda a, x: xor(a // 256, v[xor(a % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM g, crc),
n AS (SELECT bucket, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) AS s,
             CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) AS t FROM f JOIN k USING (g) GROUP BY bucket),
a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM n),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
         FROM n, a),
m AS (SELECT no, count(*) AS n_features, sum(gain) AS total FROM f JOIN k USING (g) JOIN gain USING (bucket)
      WHERE side = 0 GROUP BY no),
r AS (SELECT id AS doc_id, len(w) < 20 AS short, coalesce(n_features, 0) AS n_features, coalesce(CAST(
             (total - ((total % n_features) + n_features) % n_features) // n_features AS BIGINT), 0) AS weight,
             CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN m USING (no) WHERE side = 0),
x AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY short, score DESC, doc_id) AS place,
             25 * count(*) FILTER (WHERE NOT short) OVER () // 100 AS drawn FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM o"""


def rate_repetition(spark: SparkSession, sf: str) -> DataFrame:
    from .repetition import repetition
    return repetition(table(spark, sf, "documents")).drop("longest_repeat", "repeats")


def _twice_sql(name: str, n: int) -> str:
    """Windows of `n` words that their text holds twice or more: `no`, `i`."""
    return (f"{name} AS (SELECT no, i FROM (SELECT no, i, count(*) OVER (PARTITION BY no, g) AS c FROM ("
            f"SELECT no, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT no, w, "
            f"unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n}))) WHERE c > 1)")


def _inside_sql(windows: str, n: int) -> str:
    return (f"(SELECT no, count(DISTINCT x) AS n FROM (SELECT no, unnest(range(i, i + {n})) AS x "
            f"FROM {windows}) GROUP BY no)")


# A text has a repeat of n words or more where a window of n words is found twice.
REPETITION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(
             coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
{_twice_sql("three", 3)}, {_twice_sql("ten", 10)}, {_twice_sql("beyond", 101)},
b AS (SELECT d.*, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines,
             CAST(len(w) AS BIGINT) AS n_words, coalesce(r.n, 0) AS n_repeat_words, coalesce(c.n, 0) AS n_covered_words,
             no IN (SELECT no FROM beyond) AS long_repeat
      FROM d LEFT JOIN {_inside_sql("three", 3)} r USING (no) LEFT JOIN {_inside_sql("ten", 10)} c USING (no)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  n_covered_words, NOT base_failed AND 100 * n_covered_words <= 30 * n_words AND NOT long_repeat AS kept
FROM f"""


def cluster_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from .centroids import cluster
    return cluster(table(spark, sf, "embeddings"))


def _cluster_sql(rounds: int = 10) -> str:
    """One query a round, each over the one before it."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - p[i]) * (v[i] - p[i])))"
    nearest = ("(SELECT no, vec_id, v, c, p, d FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY d, c) AS r "
               f"FROM (SELECT no, vec_id, v, c, p, {square} AS d FROM e, {{0}})) WHERE r = 1)")
    out = ["""WITH e AS MATERIALIZED (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding,
             lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS p FROM (
           SELECT sha256('3:' || vec_id) AS h, v FROM e ORDER BY h, v LIMIT 8))"""]
    for i in range(rounds):
        near = nearest.format(f"c{i}")
        out.append(f"""s{i} AS (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (
           SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM {near}) GROUP BY c, i),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.p, o.p) AS p FROM c{i} o LEFT JOIN (SELECT c, list(
           CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p FROM s{i} GROUP BY c) m ON m.c = o.c)""")
    out.append(f"a AS (SELECT *, CAST(d AS BIGINT) AS distance FROM {nearest.format(f'c{rounds}')})")
    return ",\n".join(out) + """
SELECT vec_id, CAST(c AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
FROM a"""


QUERIES = {
    "op1_preferences": preferences,
    "op2_jaccard": link_near_copies,
    "op3_toxicity": score_toxic,
    "op4_mtree": search_vectors,
    "op5_language": predict_language,
    "op6_secrets": scan_for_secrets,
    "op7_pseudonyms": pseudonyms,
    "op8_pack": pack_documents,
    "op9_shard": shard_documents,
    "op10_decontaminate": decontaminate,
    "op11_resample": resample_documents,
    "op12_repetition": rate_repetition,
    "op13_centroids": cluster_vectors,
}
ORACLES = {
    "op1_preferences": PREFERENCES_SQL,
    "op4_mtree": SEARCH_SQL,
    "op10_decontaminate": DECONTAMINATE_SQL,
    "op11_resample": RESAMPLE_SQL,
    "op12_repetition": REPETITION_SQL,
    "op13_centroids": _cluster_sql(),
}
