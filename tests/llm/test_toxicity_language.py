import numpy as np
import pytest

from obralake.llm import ftrl
from obralake.llm.langid import identify
from obralake.llm.toxicity import character_model, decode, restore, score_toxicity, without_toxic

from .common import SF, documents, prose


@pytest.fixture(scope="module")
def model(spark):
    """Of plain words, among them those that the tests disguise."""
    text = " ".join(["idiot stupid loser worthless hello mister little tree ballot isolate adore"] * 30)
    return character_model(documents(spark, [(i, prose(i, 200) + " " + text) for i in range(10)]), "text")


@pytest.mark.parametrize("word, plain", [
    ("1d10t", "idiot"), ("stup1d", "stupid"), ("l0$er", "loser"), ("s.t.u.p.i.d", "stupid"),
    ("l o s e r", "loser"), ("looooser", "loser"), ("w0rthle55", "worthless")])
def test_viterbi_finds_the_plain_word(model, word, plain):
    assert decode(word, model) == plain


def brute_decode(word, model, readings):
    best = max(readings, key=lambda r: r[0])
    return best[1]


def test_viterbi_is_the_best_path(model):
    """Against all readings of a short word, with the costs written out."""
    import itertools
    options = [[("l", 0.0)], [("o", 0.5)], [("s", 0.5)], [("e", 0.5)], [("r", 0.0)]]
    options[1].append(("", 9e9))  # digits are not left out
    options[2] += [("", 0.7)]
    every = []
    for path in itertools.product(*options):
        text, score, p, q = "", 0.0, 0, 0
        for c, cost in path:
            score -= cost
            for x in c:
                i = ord(x) - 96
                score += model[p, q, i]
                p, q = q, i
            text += c
        every.append((score + model[p, q, 0], text))
    assert decode("l0$3r", model) == brute_decode("l0$3r", model, every)


def test_restoration_leaves_plain_words_alone(model):
    for text in ["Plain words, all of them.", "It was 1999 and 42 people, a1", "", None, "x" * 1000, "a b",
                 "wow!! great!!", "Of%%% athe*** the$$$", "A\n\nB"]:
        assert restore(text, model) == (text or "")
    assert restore("you 1d10t, go", model).split() == ["you", "idiot", "go"]
    assert restore("such a l o s e r today", model).split() == ["such", "a", "loser", "today"] or \
        "loser" in restore("such a l o s e r today", model)


DISGUISES = {"l0$3r": "loser", "l053r": "loser", "5h17": "shit", "a55": "ass", "a$$": "ass", "h473": "hate",
             "worthle55": "worthless", "st.upid": "stupid", "!diot": "idiot", "idio+": "idiot",
             "st" + "u" * 60 + "pid": "stupid", "--".join("stupid"): "stupid", ("-" * 12).join("stupid"): "stupid",
             ("." * 40).join("loser"): "loser"}


@pytest.fixture(scope="module")
def plain_model(spark):
    words = "idiot stupid loser worthless hate shit ass hello mister little tree well known don t it s a the"
    return character_model(documents(spark, [(1, " ".join([words] * 300))]), "text")


@pytest.mark.parametrize("word, plain", DISGUISES.items())
def test_restoration_reaches_disguises(plain_model, word, plain):
    assert restore(f"you {word}, go", plain_model).split()[:2] == ["you", plain]


def test_model_rejects_plain_words_with_signs(plain_model):
    for text in ["a well-known tree", "don't, it's", "hello! little!!", "the$$$ a$$$", "mister 1999", "tree.Hello"]:
        assert restore(text, plain_model) == text


def test_long_runs_are_decoded_whole(plain_model):
    for n in (1, 20, 3000):
        word = "loser" + "stupid" * n
        assert restore(" ".join(word) + " tree", plain_model).split() == [word, "tree"]
        assert restore(word.replace("u", "uuu").replace("e", "3"), plain_model).split() == [word]


def test_disguised_texts_score_as_plain_ones(spark):
    words = ["loser", "shit", "ass", "hate", "worthless", "stupid", "idiot"]
    rows = [(i, prose(i, 30) + (f" you {words[i // 2 % 7]} " if i % 2 else " you hello ") + "go") for i in range(700)]
    odd = [(1000 + i, f"{prose(3, 30)} you {w} go") for i, w in enumerate(DISGUISES)]
    odd.append((2000, prose(3, 30) + " " + " ".join("loser" + "hello" * 20)))
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    got = score_toxicity(documents(spark, rows + odd), marks).collect()
    assert {r.doc_id: r.predicted for r in got if r.doc_id >= 1000} == {i: 1 for i, _ in odd}


def test_toxic_texts_are_told_apart(spark):
    bad = ["idiot", "loser", "stupid"]
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40).split()
        if i % 4 == 0:
            words.insert(7, bad[i // 4 % 3])
        rows.append((i, " ".join(words)))
        if i < 300:
            labels.append((i, int(i % 4 == 0)))
    rows += [(1000, prose(1, 30) + " you 1d10t"), (1001, None), (1002, ""), (1003, prose(3, 20000)),
             (1004, prose(4, 30) + " l.o.s.e.r " + prose(5, 30)), (5, rows[5][1])]
    docs = documents(spark, rows, "score long, predicted string, _y int")
    marks = spark.createDataFrame([*labels, (None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    got = score_toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r.predicted for r in got}
    wrong = [i for i in range(300, 400) if by_id[i] != (i % 4 == 0)]
    assert not wrong
    assert [by_id[i] for i in (1000, 1001, 1002, 1003, 1004)] == [1, 0, 0, 0, 1]
    kept = without_toxic(docs, marks)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if not r.predicted)


def test_nothing_to_learn(spark):
    docs = documents(spark, [(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in score_toxicity(docs, none).collect()] == [(0.0, 0)] * 2
    assert score_toxicity(documents(spark, []), none).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in identify(unlabelled, unlabelled).collect()} == {"und"}
    assert identify(unlabelled.limit(0), unlabelled).collect() == []


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "12 34 !!"), (-3, ""), (-4, "der die das nicht und " * 4000)],
                                "doc_id long, text string").selectExpr("*", "'xx' AS lang", "'s' AS source", "1L AS n_chars")
    learn = docs.filter("doc_id % 3 > 0")
    got = identify(docs.unionByName(odd), learn, keep=["lang"]).collect()
    held = [r for r in got if r.doc_id % 3 == 0 and r.doc_id >= 0]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[-1] == by_id[-2] == by_id[-3] == ("und", 0.0) and by_id[-4][0] == "de"


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 600)
    rows = [(np.r_[c, rng.choice(np.arange(3, 200), 8, replace=False)], np.ones(9)) for c in y]
    w = ftrl.fit(rows, y, 3, 200)
    right = [int((w[:, a] @ v).argmax()) == c for (a, v), c in zip(rows, y)]
    assert np.mean(right) > 0.98 and (w[:, 3:] == 0).mean() > 0.3


def test_temperature_lessens_the_log_loss():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 500)
    scores = np.where(np.arange(2) == y[:, None], 4.0, 0.0) * np.where(rng.random(500) < 0.8, 1, -1)[:, None]
    t = ftrl.temperature(scores, y)
    loss = lambda t: -np.log(ftrl.softmax(scores / t)[np.arange(500), y]).mean()
    assert loss(t) < loss(1.0) and t > 1
    assert ftrl.temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_hot_and_null_texts_do_not_fill_the_sample(spark, monkeypatch):
    rows = [(i, "the same words again and again", "en") for i in range(600)] + [(1000 + i, None, "en") for i in range(400)]
    rows += [(7, "the same words again and again", "en")] * 300 + [(2000 + i, f"palavras de outra língua {i}", "pt") for i in range(40)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen, real = [], ftrl.fit
    monkeypatch.setattr(ftrl, "fit", lambda x, *rest, **more: seen.append(len(x)) or real(x, *rest, **more))
    got = identify(learn.filter("doc_id >= 2000 or doc_id = 1"), learn, sample=60).collect()
    assert seen[0] <= 120 and {r.lang_pred for r in got} == {"en", "pt"}
