"""Searches for tables of phrases against plain versions."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from obralake.operators import search

WORDS = "Cabo flexível DISJUNTOR tripolar caixa 4x2 água PVC 20 A tubo de luz".split()


def folded(text):
    return "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if not unicodedata.combining(c))


def words(text):
    return [w for w in re.split(r"[^\w]+|_", folded(text)) if w]


def grams(text):
    return {("  " + w + " ")[i:i + 3] for w in words(text) for i in range(len(w) + 1)}


def made(n, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))) for i in range(n)]
    return rows + [(n, "a", None), (n + 1, "a", ""), (n + 2, "b", "-- !"), (n + 3, None, "Cabo PVC"), (0, "a", "CABO pvc"),
                   (n + 4, "a", "cabo  pvc"), (n + 5, "b", "tubo " * 400)]


def frame(spark, rows, key, text):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 f"{key} int, mes string, {text} string, n int, part string").repartition(3)


def test_trigram_join_matches_all_pairs(spark, monkeypatch):
    left, right = made(60, 1), made(90, 2)
    for spread, threshold in ((50_000, 0.3), (5, 0.55), (5, 1.0)):
        monkeypatch.setattr(search, "SPREAD", spread)
        got = search.trigram_join(frame(spark, left, "p", "frase"), frame(spark, right, "i", "descricao"), "p", "i",
                                  by=["mes"], threshold=threshold).collect()
        want = []
        for p, mp, tp in left:
            for i, mi, ti in right:
                a, b = grams(tp), grams(ti)
                if mp is not None and mp == mi and a and b and len(a & b) / len(a | b) >= threshold:
                    want.append((p, i, round(len(a & b) / len(a | b), 9)))
        assert sorted((r.p, r.i, round(r.semelhanca, 9)) for r in got) == sorted(want) and want


def test_token_search_join_matches_all_pairs(spark, monkeypatch):
    left, right = made(40, 3), made(200, 4)
    for spread in (50_000, 7):
        monkeypatch.setattr(search, "SPREAD", spread)
        got = search.token_search_join(frame(spark, left, "q", "consulta"), frame(spark, right, "d", "descricao"),
                                       "q", "d", 4, by=["mes"]).collect()
        want = []
        for q, mq, tq in left:
            ask = set(words(tq))
            hits = [(len(ask) / len(set(words(t))), d) for d, m, t in right
                    if ask and mq is not None and m == mq and ask <= set(words(t))]
            ranked = sorted(hits, key=lambda h: (-h[0], h[1]))[:4]
            want += [(q, d, round(x, 9), r) for r, (x, d) in enumerate(ranked, 1)]
        assert sorted((r.q, r.d, round(r.peso, 9), r.posto) for r in got) == sorted(want) and want


def test_joins_of_empty_tables(spark):
    none, some = frame(spark, [], "p", "frase"), frame(spark, made(5, 1), "i", "descricao")
    assert search.trigram_join(none, some, "p", "i").collect() == []
    assert search.trigram_join(some, none, "i", "p", "descricao", "frase").collect() == []
    assert search.token_search_join(none, some, "p", "i", query="frase").collect() == []


def test_no_cross_join_and_keys_carry_the_month(spark):
    rows = frame(spark, made(5, 1), "i", "descricao")
    found = search.trigram_join(rows.withColumnsRenamed({"i": "p", "descricao": "frase"}), rows, "p", "i", by=["mes"])
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert found.filter(F.col("p").isNull()).count() == 0


def test_only_tokens_of_queries_are_stored(spark, monkeypatch):
    kept = {}

    def store(df, name):
        kept[name] = df.cache()
        return kept[name]

    monkeypatch.setattr(search, "store", store)
    queries = spark.createDataFrame([(1, "cabo azul"), (2, "tubo nenhum")], "q bigint, consulta string")
    docs = spark.createDataFrame([(1, "Cabo azul flexível"), (2, "cabo verde"), (3, "tubo azul"), (4, None)],
                                 "d bigint, descricao string")
    got = search.token_search_join(queries, docs, "q", "d").collect()
    assert [(r.q, r.d, r.posto) for r in got] == [(1, 1, 1)]
    assert {r.token for r in kept["postings"].collect()} == {"cabo", "azul", "tubo"}


def test_rules_read_texts_before_they_are_paired(spark):
    """What is read of a text stands below the join, so it is read once per text."""
    import __spark_entry__ as entry

    for name in ("measure_hit", "weighted_containment"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Join")]
        assert "regexp" not in above and "md5" not in above


def test_blocks_and_prefixes_give_the_same_pairs(spark, monkeypatch):
    """Texts that meet in many trigrams are compared in blocks, however small these are."""
    monkeypatch.setattr(search, "BLOCK", 7)
    phrases = spark.createDataFrame(made(60, 21), "k bigint, brand string, frase string")
    items = spark.createDataFrame(made(50, 22), "i bigint, brand string, descricao string")
    found = {}
    for name, count in (("blocks", (2, 1)), ("prefixes", (1, 2))):
        monkeypatch.setattr(search, "_meetings", lambda *a, count=count: count)
        for by in ((), ("brand",)):
            rows = search.trigram_join(phrases, items, "k", "i", by=by).collect()
            found[name, by] = sorted((r.k, r.i, r.semelhanca) for r in rows)
    assert found["blocks", ()] == found["prefixes", ()] and found["blocks", ("brand",)] == found["prefixes", ("brand",)]
    assert len(found["blocks", ()]) > len(found["blocks", ("brand",)]) > 0


def test_keys_travel_with_their_text_and_pairs_do_not(spark, monkeypatch):
    """Texts with more copies than go together, keys that are null or come twice: a row for each pair of keys."""
    monkeypatch.setattr(search, "KEYS", 3)
    texts = ["blue gear", "blue gears", "red bolt", None, "?"]
    phrases = [(None if i % 7 == 3 else i // 2, texts[i % 5]) for i in range(40)]
    items = [(f"i{i // 2}", texts[i % 3]) for i in range(50)]
    left = spark.createDataFrame(phrases, "k bigint, frase string")
    right = spark.createDataFrame(items, "i string, descricao string")
    like = {("blue gear", "blue gears"), ("blue gears", "blue gear"), *((t, t) for t in texts[:3])}
    want = sorted((str(k), i) for k, p in phrases for i, t in items if (p, t) in like)
    for count in ((2, 1), (1, 2)):
        monkeypatch.setattr(search, "_meetings", lambda *a, count=count: count)
        found = search.trigram_join(left, right, "k", "i")
        assert sorted((str(r.k), r.i) for r in found.collect()) == want
        if count == (2, 1):  # nothing is joined once the blocks are compared
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan[:plan.index("FlatMapGroups")]
