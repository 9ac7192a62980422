"""Normalisation and rule cases worked by hand."""

import pytest
from pyspark.sql import functions as F

from obralake.functions import lexical
from obralake.functions import parsing as P
from obralake.functions import rules as R
from obralake.functions import text as T


def apply(spark, values, fn, *more):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_normalize(spark):
    cases = {
        "4,00mm²": "4MM", "DISJ 10 A": "DISJUNTOR 10A",
        "PLACA 2+2 POSTOS 4X4": "PLACA ESPELHO 2 2 POSTOS 4X4", "40 - 50 A": "40 50A",
        "QUADRO 100,50 V": "QUADRO 100.5V", "Cabo FlexSil 750 V 2,50 Cinza":
        "CABO CABO COBRE FLEXIVEL 750V 2.5MM2 CINZA", "Módulo nº 3": "MODULO N 3"}
    assert apply(spark, cases, T.normalize) == list(cases.values())


def test_standardize(spark):
    cases = {'4" X 2"': "4X2", "1+2 POSTOS": "3 POSTOS", "1+2+3 POSTOS": "1+5 POSTOS",
             "4 X 2.5": "4 X 2.5", "4X4 MM": "4X4 MM", "1+1 POSTO 2+2 POSTOS": "2 POSTOS 4 POSTOS"}
    assert apply(spark, cases, T.standardize) == list(cases.values())


def test_ranges_mode_keeps_signs(spark):
    text = ["DISJ 40 - 50 A", "PLACA 2+2 POSTOS"]
    assert apply(spark, text, lambda v: T.product_text(v, "ranges")) == [
        "DISJUNTOR 40 - 50A", "PLACA ESPELHO 4 POSTOS"]
    low = apply(spark, ["40 - 50 A"], T.amp_ranges)[0]
    assert [(r["lo"], r["hi"]) for r in low] == [(40.0, 50.0)]
    with pytest.raises(ValueError):
        T.product_text(F.lit("x"), "other")


def test_codes_and_attributes(spark):
    assert apply(spark, ["PLACA 739204 X KB2217Q0TX 00071.254 FIM", "CO8X1 A"], T.strip_codes) == [
        "PLACA X FIM", "CO8X1 A"]
    assert apply(spark, ["BIPOLAR", "3 POLOS", "NADA"], T.pole_count) == [2, 3, None]
    assert apply(spark, ["PLACA CEGA 2 POSTOS", "2 POSTOS", "X"], T.gang_count) == [0, 2, None]
    assert apply(spark, ["A 4X4 B", "14X4"], T.plate_size) == ["4X4", None]
    assert apply(spark, ["10A 2.5 A 3AB"], T.amperages) == [[10.0, 2.5]]
    assert apply(spark, ["2P+T 10MM2 1.5.7"], T.numbers) == [["2", "10", "1.5"]]


def pair(spark, sku, item, fn):
    df = spark.createDataFrame([(sku, item)], "s string, c string")
    return df.select(fn(F.col("s"), F.col("c"))).first()[0]


def test_rules(spark):
    assert pair(spark, "DISJ 10 20", "X 10 5", R.measure_hit) == 0.5
    assert pair(spark, "CABO 750 1", "X", R.measure_hit) is None
    assert pair(spark, "DISJUNTOR 45", "DISJUNTOR 40 - 50 A", R.measure_hit) == 1.0
    adjust = lambda s, c: round(pair(spark, s, c, R.type_adjustment), 6)
    assert adjust("DISJUNTOR BIPOLAR", "DISJUNTOR TRIPOLAR") == 0.5
    assert adjust("PLACA 2 POSTOS 4X2", "ESPELHO 1 POSTO 4X4") == round(0.45 * 0.6, 6)
    assert adjust("PLACA X", "TOMADA") == 0.5
    assert adjust("CABO 5X4", "CABO 1 CONDUTOR") == 0.35
    assert adjust("KIT EMBUTIR", "CAIXA SOBREPOR") == round(0.7 * 0.55, 6)
    assert adjust("MODULO TOMADA", "CONJUNTO MONTADO") == 0.9


def test_token_set(spark):
    pairs = {("a b c", "c b a"): 1.0, ("fuzzy wuzzy", "wuzzy fuzzy bear"): 1.0, ("", ""): 0.0, ("a", ""): 0.0,
             ("abcd", "abce"): 0.75, ("x abcd", "x abce"): max(2 * 5 / 12, 2 / 7)}
    df = spark.createDataFrame(list(pairs), "a string, b string")
    got = {(r["a"], r["b"]): r["x"] for r in df.select("a", "b", lexical.token_set_ratio("a", "b").alias("x")).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in pairs.items()}


def test_parsing(spark):
    assert apply(spark, ["7.9", "1.0d", "inf", "1_000", " 5 ", "-2e1", ""], P.to_int) == [
        7, None, None, None, 5, -20, None]
    assert apply(spark, ["Preço  (R$)", " É_1 "], P.clean_name) == ["preço_r", "é_1"]
    assert apply(spark, ["Analítico", "A-B c"], P.safe_sheet_name) == ["analítico", "a-b_c"]
    assert apply(spark, [None, "nan", " Insumo"], P.item_type) == [
        "COMPOSICAO_MAE", "COMPOSICAO_MAE", "INSUMO"]


def test_texts_are_cut_into_tokens_once_and_not_per_pair(monkeypatch):
    from obralake.functions import lexical
    seen = []
    plain = lexical.re.split
    monkeypatch.setattr(lexical.re, "split", lambda p, t: seen.append(t) or plain(p, t))
    items = ["CABO AZUL", "cabo\u00a0x", None, ""]
    got = lexical.ratios(["CABO VERDE"] * 4, items)
    assert len(seen) == 5 and got[2] == got[3] == 0.0 and 0 < got[0] < 1
