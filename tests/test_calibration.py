"""Calibration on labelled pairs: the published holdout, and every cut against plain counting."""

import random

import pytest
from pyspark.sql import functions as F

from obralake.operators import calibration as C
from obralake.operators import linkage as L

SCHEMA = "rotulo string, gold_codigo long, nivel string, top1 long, score double, extra int"


def holdout(spark):
    """60 rows with the published counts: right first choices of all rows by tier, 35 rows with a pair."""
    rows, i = [], 0
    for tier, low, right, wrong, none, family in (("alta", .6, 18, 0, 1, 1), ("media", .5, 9, 2, 3, 1),
                                                  ("baixa", .4, 5, 1, 4, 0), ("sem_par", .2, 0, 0, 14, 1)):
        for label, hit, n in (("par", True, right), ("par", False, wrong), ("sem_par", False, none),
                              ("familia", False, family)):
            for _ in range(n):
                i += 1
                top = None if tier == "sem_par" else i
                rows.append((label, i if hit else 1000 + i if label == "par" else None, tier, top, low + i / 1000, 1))
    return spark.createDataFrame(rows, SCHEMA)


def test_published_holdout(spark):
    gold = holdout(spark)
    assert gold.count() == 60 and {r.rotulo: r["count"] for r in gold.groupBy("rotulo").count().collect()} == {
        "par": 35, "sem_par": 22, "familia": 3}
    found = {r.nivel: (r.certos, r.total, r.pares) for r in L.evaluate(gold).collect()}
    assert {t: v[:2] for t, v in found.items()} == {"alta": (18, 20), "media": (9, 15), "baixa": (5, 10), "sem_par": (0, 15)}
    assert found["sem_par"][2] == 0 and gold.filter(C.is_right()).count() == 32
    last = C.calibration_curve(gold).orderBy("limite").first()
    assert (last.total, last.certos, last.outros, last.familias, last.nenhuns) == (60, 32, 3, 3, 22)
    assert last.alcance == pytest.approx(32 / 35) and last.precisao == pytest.approx(32 / 60)
    at_high = C.calibration_curve(gold).filter("limite >= 0.6").orderBy("limite").first()
    assert (at_high.certos, at_high.total) == (18, 20)


def test_every_cut_matches_plain_counting(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["par", "par", "sem_par", "familia"]), rng.randint(1, 3), "x", rng.choice([1, 2, 3, None]),
             rng.choice([None, *[k / 20 for k in range(20)]]), 0) for _ in range(400)]
    rows = [(a, b if a == "par" else None, *r) for a, b, *r in rows]
    got = {r.limite: r for r in C.calibration_curve(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    pairs = sum(r[0] == "par" for r in rows)
    assert set(got) == {r[4] for r in rows} - {None}
    for cut, r in got.items():
        taken = [x for x in rows if x[4] is not None and x[4] >= cut]
        right = sum(x[0] == "par" and x[1] == x[3] for x in taken)
        assert (r.total, r.certos, r.outros + r.certos) == (len(taken), right, sum(x[0] == "par" for x in taken))
        assert r.familias == sum(x[0] == "familia" for x in taken) and r.precisao == pytest.approx(right / len(taken))
        assert r.alcance == pytest.approx(right / pairs) and r.f1 == pytest.approx(2 * right / (len(taken) + pairs))
    curve = C.calibration_curve(spark.createDataFrame(rows, SCHEMA))
    best = max(got.values(), key=lambda r: (r.f1, r.limite))
    assert C.best_limit(curve).first().limite == best.limite
    able = [c for c, r in got.items() if r.precisao >= 0.2]
    assert [r.limite for r in C.lowest_limit(curve, 0.2).collect()] == sorted(able)[:1]


def test_no_scores_and_empty_table(spark):
    none = spark.createDataFrame([("par", 1, "x", 1, None, 0)], SCHEMA)
    assert C.calibration_curve(none).collect() == [] and C.calibration_curve(none.limit(0)).collect() == []
    alone = spark.createDataFrame([("sem_par", None, "x", 1, 0.5, 0)], SCHEMA)
    row = C.calibration_curve(alone).select("total", "certos", F.col("alcance").isNull().alias("none")).first()
    assert tuple(row) == (1, 0, True)
