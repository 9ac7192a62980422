"""Suffix arrays against brute force, and the rules on worked texts."""

import random
import re

import numpy as np

from obralake.llm import repetition
from obralake.llm.repetition import covered, longest_repeats, without_repetition

from .common import documents, prose


def repeats(words):
    """For each word, the words from there on that occur elsewhere too."""
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            n = 0
            while i != j and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
        out.append(best)
    return out


def union(reach, least):
    inside = [False] * len(reach)
    for i, n in enumerate(reach):
        if n >= least:
            inside[i:i + n] = [True] * n
    return inside


def brute(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    reach = repeats(words)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    three, ten, n = sum(union(reach, 3)), sum(union(reach, 10)), len(words)
    failed = n < 50 or 100 * three > 50 * n
    good = not failed and 100 * ten <= 30 * n and max(reach, default=0) <= 100
    return (i, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            three, failed, ten, max(reach, default=0), good)


def texts():
    a, b = prose(1, 90), prose(2, 400)
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, a), (6, a + " " + a), (7, prose(3, 49)), (8, prose(4, 50)),
            (9, "x " * 300), (10, b + "\n" + prose(5, 9) + "\n" + b[:200] + "\n" + b[:200]), (11, "a # b* $\n" * 20),
            (12, prose(6, 150) + " q " + prose(7, 600) + " r " + prose(6, 150)), (13, " x y   z " + a),
            (13, a), (None, prose(8, 70)), (14, "same line\nsame line \nsame line\n\n\n" + a), (15, "😀 ä " * 30 + a)]


def test_longest_repeats_match_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        docs = [[rng.randrange(rng.randint(1, 3)) for _ in range(rng.choice([0, 1, 2, 7, 60]))] for _ in range(4)]
        docs[0] = docs[0] * 2 + [9] + docs[0]
        codes = np.array([w for d in docs for w in d], np.int64)
        got = longest_repeats(codes, np.repeat(np.arange(4), [len(d) for d in docs]))
        assert got.tolist() == [x for d in docs for x in repeats(d)]
        assert covered(got[:len(docs[0])], 3).tolist() == union(repeats(docs[0]), 3)


def test_rules_match_brute_force(spark, monkeypatch):
    rows = documents(spark, texts(), "n_words long, kept string, k0 long").repartition(3)
    for gathered in (1 << 16, 200):
        monkeypatch.setattr(repetition, "GATHERED", gathered)
        got = repetition.repetition(rows).drop("repeats").collect()
        assert sorted(map(tuple, got), key=str) == sorted((brute(*r) for r in texts()), key=str)


def test_kept_documents_have_their_columns(spark):
    want = sorted((r[0] for r in map(lambda r: brute(*r), texts()) if r[-1]), key=str)
    got = without_repetition(documents(spark, texts(), "n_words long, kept string, k0 long")).collect()
    assert sorted((r.doc_id for r in got), key=str) == want and got[0].n_words == 7


def test_spans_of_repeats(spark):
    a = prose(1, 20)
    rows = documents(spark, [(1, a + " x y " + a + " z")])
    assert [tuple(s) for s in repetition.repetition(rows).first().repeats] == [(0, 20), (22, 42)]


def test_very_long_text_and_empty_table(spark):
    assert repetition.repetition(documents(spark, [])).collect() == []
    row = repetition.repetition(documents(spark, [(1, "a b " * 150_000)])).first()
    assert row.n_repeat_words == row.n_covered_words == 300_000 and row.longest_repeat == 299_998
