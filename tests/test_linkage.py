"""Linkage and neighbours against brute force, on data with hot terms and many copies."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obralake.functions import lexical
from obralake.functions import text as T
from obralake.operators import linkage as L
from obralake.operators import neighbours as N
from obralake.operators import signals
from obralake.plans import linkage as plan

WORDS = "CABO PLACA DISJUNTOR TOMADA CAIXA LUVA TUBO FIO RALO CANO PREGO LAMPADA".split()


def names(n, seed):
    """A third of all rows are one text; one word is in every text."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if rng.random() < 1 / 3:
            out.append("PECA CABO 10MM")
        else:
            out.append("PECA " + " ".join(rng.choices(WORDS, k=rng.randint(1, 4)))
                       + f" {rng.randint(1, 30)}MM")
    return out


def cosines(items, skus):
    def terms(n):
        t = [w for w in n.split() if w not in T.STOP_WORDS]
        return Counter(t + [f"{a} {b}" for a, b in zip(t, t[1:])])
    docs = [terms(n) for n in items + skus]
    df = Counter(t for d in docs for t in d)
    at = {t: i for i, t in enumerate(df)}
    m = np.zeros((len(docs), len(at)))
    for r, d in enumerate(docs):
        for t, c in d.items():
            m[r, at[t]] = (1 + math.log(c)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    return np.round(m[len(items):] @ m[:len(items)].T, 9)


def ranked(scores, k):
    return [j for _, j in sorted(((s, j) for j, s in enumerate(scores)), reverse=True)[:k]]


def frames(spark, items, skus):
    i = spark.createDataFrame(list(enumerate(items)), "item_key bigint, n string")
    s = spark.createDataFrame(list(enumerate(skus)), "sku_key bigint, n string")
    return i, s


@pytest.mark.parametrize("spread, seeds, checked", [(100_000, 250, 16), (20, 5, 2)])
def test_preselect_is_exact(spark, monkeypatch, spread, seeds, checked):
    monkeypatch.setattr(L, "TERM_SPREAD", spread)
    monkeypatch.setattr(L, "SEED_LIST", seeds)
    monkeypatch.setattr(L, "CHECKED", checked)
    items, skus = names(300, 1), names(60, 2) + ["SOZINHO", "PECA"]
    i, s = frames(spark, items, skus)
    vectors = L.store(L.tfidf_vectors(i, s), "vectors")
    got = {}
    for r in L.preselect(i, vectors, 15).collect():
        got.setdefault(bytes(r["sid"]), {})[r["posto"]] = r["item_key"]
    scores = cosines(items, skus)
    for row, text in enumerate(skus):
        mine = got[hashlib.md5(text.encode()).digest()]
        assert [mine[p] for p in sorted(mine)] == ranked(scores[row], 15), text


def test_copies_are_ranked_within_a_row(spark):
    """Candidates move as pairs of texts, however many copies of an item text are among them; ties of two
    texts alternate by key."""
    items, skus = (["CABO AZUL", "AZUL CABO", "LUVA"] * 30)[:-1], ["CABO", "AZUL", "LUVA 10MM", "SOZINHO"]
    i, s = frames(spark, items, skus)
    vectors = L.store(L.tfidf_vectors(i, s), "vectors")
    pairs = L.candidate_texts(i, vectors, 40).cache()
    assert pairs.count() <= 3 * len(skus)
    scores = cosines(items, skus)
    got = {}
    for r in L.by_item(pairs).collect():
        got.setdefault(bytes(r["sid"]), {})[r["posto"]] = r["item_key"]
    for row, text in enumerate(skus):
        mine = got[hashlib.md5(text.encode()).digest()]
        assert [mine[p] for p in sorted(mine)] == ranked(scores[row], 40), text


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def token_set(left, right):
    a, b = set((left or "").split()), set((right or "").split())
    if not a or not b:
        return 0.0
    s, x, y = (" ".join(sorted(t)) for t in (a & b, a - b, b - a))
    if s and (not x or not y):
        return 1.0
    ratio = lambda m, n: 2 * common(m, n) / (len(m) + len(n))
    return max(ratio(f"{s} {x}", f"{s} {y}"), ratio(s, f"{s} {x}"), ratio(s, f"{s} {y}")) if s else ratio(x, y)


def test_token_set_similarity(spark):
    texts = sorted(set(names(25, 8))) + ["", "A", "ÇÃO É", "X " * 3, "Z" * 70 + " K", "PECA " + "CABO LUVA " * 9, None]
    rows = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", lexical.token_set_ratio("a", "b").alias("x")).collect()
    assert all(abs(r["x"] - token_set(r["a"], r["b"])) < 1e-12 for r in got)
    t = signals._Texts(pd.Series([x or "" for x in texts]))
    bound = signals._letter_bounds(t, t)
    exact = np.array([[token_set(a, b) for b in texts] for a in texts])
    assert (bound >= exact - 1e-12).all()
    rng = random.Random(1)
    a, b = (["".join(rng.choices("abcd ", k=rng.randint(0, 80))) for _ in range(300)] for _ in range(2))
    assert lexical.common_lengths(a, b).tolist() == [common(x, y) for x, y in zip(a, b)]


def test_few_pairs_are_aligned(spark):
    """Of products and items with meaningful vectors, as in real use."""
    items, skus = sorted(set(names(600, 3))), sorted(set(names(200, 4)))
    rng = np.random.default_rng(5)
    at = {w: rng.normal(size=16) for n in items + skus for w in n.split()}
    vector = lambda n: (v := sum(at[w] for w in n.split())) / np.linalg.norm(v)
    frame = lambda key, texts: spark.createDataFrame(
        [(k, n, vector(n).tolist()) for k, n in enumerate(texts)], f"{key} bigint, n string, vetor array<double>")
    i, s = frame("item_key", items), frame("sku_key", skus)
    vectors = L.store(L.tfidf_vectors(i, s), "vectors")
    found = signals.signal_topk(vectors, plan._text_vectors(s, "sku_key", "sid", "vetor"),
                                plan._text_vectors(i, "item_key", "iid", "vetor"), 10,
                                L.effective_weights(("tf", "emb", "lex")), "vetor")
    assert found.agg(F.sum("aligned")).first()[0] < 0.1 * len(items) * len(skus)


def test_small_cells_leave_items_out_and_lose_nothing(spark):
    """Vectors of the texts' words: cells that cannot hold one of the best are not visited."""
    items, skus = sorted(set(names(500, 3))), sorted(set(names(60, 4)))
    rng = np.random.default_rng(6)
    at = {w: rng.normal(size=6) for n in items + skus for w in n.split()}
    vector = lambda n: (v := sum(at[w] for w in n.split())) / np.linalg.norm(v)
    frame = lambda key, texts: spark.createDataFrame(
        [(k, n, vector(n).tolist() if k % 17 else None) for k, n in enumerate(texts)],
        f"{key} bigint, n string, vetor array<double>")
    i, s = frame("item_key", items), frame("sku_key", skus)
    vectors = L.store(L.tfidf_vectors(i, s), "vectors")
    sides = plan._text_vectors(s, "sku_key", "sid", "vetor"), plan._text_vectors(i, "item_key", "iid", "vetor")
    def topk(cell, crowd):
        found = signals.signal_topk(vectors, *sides, 5, L.effective_weights(("tf", "emb", "lex")), "vetor", cell, crowd)
        return sorted((bytes(r.sid), bytes(r.iid), r.tf, r.emb, r.lex, r.base) for r in found.collect())

    want = topk(100_000, 1000)
    assert len(want) == 5 * len(skus) and topk(8, 4) == topk(30, 1000) == want


def test_length_bound_is_no_less_than_the_similarity(spark):
    texts = sorted(set(names(40, 8))) + ["", "A", "A B", "PECA", "PECA CABO"]
    rows = [(a, b, token_set(a, b)) for a in texts for b in texts]
    words = lambda t: sorted(set(t.split()))
    df = spark.createDataFrame([(len(" ".join(words(a))), len(" ".join(words(b))), len(" ".join(
        set(words(a)) & set(words(b)))), x) for a, b, x in rows], "own int, other int, shared int, x double")
    bound = signals._letters_bound(F.col("own"), F.col("other"), F.col("other"), F.col("shared"))
    assert df.filter((bound < F.col("x") - 1e-12) | (bound > 1)).count() == 0


def test_three_signals_of_empty_tables(spark):
    i = spark.createDataFrame([(1, None, None), (2, "PECA", [1.0, 0.0])], "item_key bigint, n string, vetor array<double>")
    s = spark.createDataFrame([(1, "PECA", None), (2, None, [1.0, 0.0])], "sku_key bigint, n string, vetor array<double>")
    i = i.withColumn("descricao", F.col("n"))
    got = {(r["sku_key"], r["item_key"]): (r["tf"], r["emb"], r["lex"]) for r in plan.link_signals(i, s, 5).collect()}
    assert got == {(1, 1): (0.0, 0.0, 0.0), (1, 2): (1.0, 0.0, 1.0), (2, 1): (0.0, 0.0, 0.0), (2, 2): (0.0, 1.0, 0.0)}
    assert plan.link_signals(i.limit(0), s, 5).collect() == []


def test_nearest_vectors_of_empty_and_null(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "a bigint, embedding array<double>")
    b = df.withColumnRenamed("a", "b")
    assert [(r["a"], r["b"]) for r in N.vector_topk(df, b, 3, "a", "b").collect()] == [(1, 1)]
    assert N.vector_topk(df, b.limit(0), 3, "a", "b").collect() == []


def test_three_signals_are_exact(spark):
    items, skus = sorted(set(names(150, 3))), sorted(set(names(40, 4)))
    rng = np.random.default_rng(5)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    vi, vs = unit(rng.normal(size=(len(items), 8))), unit(rng.normal(size=(len(skus), 8)))
    i = spark.createDataFrame([(k, n, "d", vi[k].tolist()) for k, n in enumerate(items)],
                              "item_key bigint, n string, descricao string, vetor array<double>")
    s = spark.createDataFrame([(k, n, vs[k].tolist()) for k, n in enumerate(skus)],
                              "sku_key bigint, n string, vetor array<double>")
    got = {}
    for r in plan.link_signals(i, s, 10).collect():
        got.setdefault(r["sku_key"], []).append((r["base"], r["item_key"]))
    tf, emb = cosines(items, skus), np.round(np.clip(vs @ vi.T, 0, 1), 9)
    for row, sku in enumerate(skus):
        lex = np.array([token_set(sku, n) for n in items])
        base = np.floor((0.35 * tf[row] + 0.45 * emb[row] + 0.2 * lex) * 1e9 + 0.50001) / 1e9
        assert [j for _, j in sorted(got[row], reverse=True)] == ranked(base, 10), sku


def test_nearest_vectors_with_hot_cell(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(400, 6))
    base[:150] = base[0]
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(base)],
                               "id bigint, embedding array<double>")
    got = {}
    rows = N.vector_topk(df.select(F.col("id").alias("a"), "embedding"),
                         df.select(F.col("id").alias("b"), "embedding"), 5, "a", "b",
                         pivots=12, block=40).collect()
    for r in rows:
        got.setdefault(r["a"], {})[r["posto"]] = r["b"]
    sims = np.round(np.clip(base @ base.T, 0, 1), 9)
    for a in range(len(base)):
        assert [got[a][p] for p in sorted(got[a])] == ranked(sims[a], 5)


def test_tiers(spark):
    rows = [(0.7, 0.1, None), (0.7, 0.1, 0.5), (0.55, 0.0, 1.0), (0.45, 0.0, 0.2), (0.39, 0.0, None)]
    df = spark.createDataFrame(rows, "s double, m double, h double")
    got = [r[0] for r in df.select(L.tier(F.col("s"), F.col("m"), F.col("h"))).collect()]
    assert got == ["alta", "baixa", "media", "baixa", "sem_par"]


def test_top_three_with_few_candidates(spark):
    df = spark.createDataFrame([(1, 10, 0.5, None), (1, 11, 0.5, 1.0)],
                               "sid int, item_key int, score double, hit double")
    r = L.top_three(df).first()
    assert (r["item_key1"], r["item_key2"], r["item_key3"], r["folga"]) == (11, 10, None, 0.0)


def test_evaluation_of_tiers(spark):
    rows = [("par", "1", "alta", "1", .7), ("par", "2", "alta", "3", .65), ("sem_par", "", "baixa", "4", .45)]
    gold = spark.createDataFrame(rows, "rotulo string, gold_codigo string, nivel string, top1 string, score double")
    got = {r["nivel"]: (r["total"], r["pares"], r["certos"], r["precisao"]) for r in L.evaluate(gold).collect()}
    assert got == {"alta": (2, 2, 1, 0.5), "baixa": (1, 0, 0, 0.0)}
    assert L.effective_weights(("tf", "lex"))["emb"] == 0.0
    assert abs(sum(L.effective_weights(("tf", "lex")).values()) - 1) < 1e-12


def test_texts_of_the_best_items_count_their_copies(spark):
    """With twenty copies of every item, one text fills ten candidates; more texts are not kept."""
    texts = sorted(set(names(60, 5)))
    items, skus = texts * 20, names(25, 6)
    i, s = frames(spark, items, skus)
    vectors = L.tfidf_vectors(i, s).cache()
    scores = cosines(items, skus)
    want = set()
    for n, row in zip(skus, scores):
        best = sorted(row, reverse=True)[9]
        want |= {(n, t) for t, score in zip(items, row) if score >= best and score > 0}
    named = vectors.select("side", "doc", "n")
    got = L.topk_texts(vectors, 10).join(
        named.filter("side = 1").select(F.col("doc").alias("sid"), F.col("n").alias("sn")), "sid").join(
        named.filter("side = 0").select(F.col("doc").alias("iid"), F.col("n").alias("cn")), "iid")
    assert {(r.sn, r.cn) for r in got.collect()} == want
    near = L.preselect(i, vectors, 10).join(named.select(F.col("doc").alias("sid"), F.col("n").alias("sn")).distinct(), "sid")
    found = {}
    for r in near.collect():
        found.setdefault(r.sn, {})[r.posto] = r.item_key
    for n, row in zip(skus, scores):
        assert [found[n][p] for p in range(1, 11)] == ranked(row, 10)


def test_terms_are_counted_where_their_text_lies(spark):
    texts = spark.createDataFrame([(1, "CABO CABO AZUL", 2), (2, "TUBO", 1)], "no bigint, n string, copies bigint")
    counts = L.term_counts(texts)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {tuple(r) for r in counts.collect()} == {
        (1, "CABO", 2, 2), (1, "AZUL", 1, 2), (1, "CABO CABO", 1, 2), (1, "CABO AZUL", 1, 2), (2, "TUBO", 1, 1)}


def test_seeds_are_compared_once_per_kind_of_product(spark):
    """Products that differ in a number no item has are one kind; every limit stays below its k-th best."""
    items, forms = names(80, 7), sorted(set(names(30, 8)))
    skus = [f"{n} {code}" for n in forms for code in ("990001", "990002 990003", "990004")]
    i, s = frames(spark, items, skus)
    vectors = L.tfidf_vectors(i, s).cache()
    terms = L.checked_terms(vectors)
    found = terms[1].select("sid", "kind").distinct().collect()
    assert len({r.kind for r in found}) <= len(forms) < len({r.sid for r in found}) == len(skus)
    limits = {r.n: r.limit for r in L.seed_limits(vectors, 5, terms).join(
        vectors.filter("side = 1").select(F.col("doc").alias("sid"), "n"), "sid").collect()}
    best = {n: sorted(row, reverse=True)[4] for n, row in zip(skus, cosines(items, skus))}
    assert all(limits[n] <= best[n] + 1e-9 for n in skus) and sum(limits.values()) > 0


def test_rules_are_read_once_per_pair_of_texts(spark):
    """Copies of an item share the row of their text: the rules lie below the join with the keys."""
    i, s = frames(spark, ["CABO FLEXIVEL 750 V"] * 5, ["CABO FLEXIVEL 2.5"])
    vectors = L.tfidf_vectors(i, s).cache()
    pairs = L.preselect(i, vectors, 5).cache()
    got = L.features(pairs, vectors)
    assert got.count() == 5 and len({(r.score, r.cont, r.base) for r in got.collect()}) == 1
    assert "Aggregate [sid#" in got._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_of_vectors_are_compared_some_queries_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    asking = pd.DataFrame({"sid": range(700), "v": list(rng.random((700, 4))), "floor": 0.0})
    offered = pd.DataFrame({"iid": range(50), "v": list(rng.random((50, 4)))})
    shapes, plain = [], np.round
    monkeypatch.setattr(np, "round", lambda x, d=0: shapes.append(x.shape) or plain(x, d))
    got = N._matches(asking, offered, 3)
    assert max(rows for rows, _ in shapes) <= N.ROWS and sum(rows for rows, _ in shapes) == 700
    monkeypatch.undo()
    scores = np.clip(np.vstack(asking["v"]) @ np.vstack(offered["v"]).T, 0, 1)
    want = {(i, j) for i, row in enumerate(np.round(scores, 9)) for j in sorted(range(50), key=lambda j: (-row[j], -j))[:3]}
    assert set(zip(got["sid"], got["iid"])) == want


def test_terms_are_not_shuffled_for_each_text(spark, monkeypatch):
    """Vectors of texts in many blocks, some null, empty or twice: weights by hand, whatever the blocks."""
    from collections import Counter
    from math import log, sqrt

    monkeypatch.setattr(L.termblocks, "BLOCK_TEXTS", 4)
    items, skus = [*names(40, 11), *names(10, 11), None, "", " DE  "], [*names(9, 12), "ZINCO\tNOVO"]
    schema = "key bigint, n string"
    i, s = (spark.createDataFrame(list(enumerate(side)), schema) for side in (items, skus))
    vectors = L.tfidf_vectors(i, s)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "term" not in "".join(line for line in plan.splitlines() if "Exchange" in line)

    def terms(n):
        words = [w for w in (n or "").split() if w not in T.STOP_WORDS]
        return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])

    df = Counter(t for n in items + skus for t in terms(n))
    idf = {t: log((1 + len(items) + len(skus)) / (1 + c)) + 1 for t, c in df.items()}
    asked = {t for n in skus for t in terms(n)}
    for only in (False, True):
        rows = L.tfidf_vectors(i, s, asked_only=only).collect()
        assert Counter((r.side, r.n, r.copies) for r in rows) == Counter(
            (side, n, c) for side, own in enumerate((items, skus)) for n, c in Counter(own).items())
        for r in rows:
            raw = {t: (1 + log(c)) * idf[t] for t, c in terms(r.n).items()}
            norm = sqrt(sum(x * x for x in raw.values()))
            want = {t: (round(x / norm, 9), df[t]) for t, x in raw.items() if r.side or not only or t in asked}
            assert {t.term: (round(t.w, 9), t.df) for t in r.terms or ()} == want
    weights = L.term_weights(vectors)
    got = L.strongest_terms(weights, 6).select("side", "term", "n", F.round("idf", 6).alias("idf"), "w").collect()
    plain = weights.groupBy("side", "term").agg(
        F.count("*").alias("n"), F.round(F.max("idf"), 6).alias("idf"), F.round(F.max("w"), 6).alias("w")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain)) and len(got) > 50


def test_few_products_meet_all_items_in_blocks(spark, monkeypatch):
    """The same candidates as by shared terms and bounds, from vectors with and without the other terms."""
    items, skus = names(90, 13) * 2, [*names(20, 14), "NADA IGUAL", ""]
    i, s = frames(spark, items, skus)
    every, asked = (L.store(L.tfidf_vectors(i, s, asked_only=only), "vectors") for only in (False, True))
    monkeypatch.setattr(L.termblocks, "ITEMS", 16)
    monkeypatch.setattr(L.termblocks, "COLUMNS", 7)
    found = [L.preselect(i, v, 7).collect() for v in (every, asked)]
    few = L.topk_texts(asked, 7)
    assert "FlatMapCoGroups" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(L, "FEW", 0)
    found.append(L.preselect(i, every, 7).collect())
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1])) == sorted(map(tuple, found[2]))
    assert len(found[0]) == 7 * len(set(skus))
