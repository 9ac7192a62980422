"""Importance resampling against a plain version, and the draw's edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

from obralake.llm import resampling
from obralake.llm.resampling import resample, weighted

from .common import documents, prose


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2) for i in range(len(w) - n + 1)]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    out = []
    for i, text in rows:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words(text)) >= 20])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for place, r in enumerate(able[:25 * len(able) // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def corpus():
    rows = [(1, None), (2, ""), (3, " \n-?"), (4, "One"), (5, "ÄPFEL und ÖL, x-y"), (6, "a\x00b\tC d" * 9), (None, prose(9, 40))]
    rows += [(10 + i, prose(i % 7, 15 + i % 12)) for i in range(80)]
    return rows + [(200, prose(3, 25))] * 3 + [(201, prose(5, 30_000))]


def test_weights_and_ranks_match_brute_force(spark):
    target = [prose(3, 60), None, "", "x y " * 30]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    rows = corpus()
    got = weighted(documents(spark, rows, "n_words int, part string, rank int").repartition(5), goal).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(brute(rows, target), key=str)


def test_drawn_documents_keep_their_columns(spark):
    goal = spark.createDataFrame([("q", prose(3, 60))], "doc_id string, text string")
    rows = [(i, prose(i, 30)) for i in range(40)]
    got = resample(documents(spark, rows), goal).collect()
    assert {r.doc_id for r in got} == {r[0] for r in brute(rows, [prose(3, 60)]) if r[4]} and len(got) == 10
    assert got[0].pos == "p"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert weighted(documents(spark, []), none).collect() == []
    rows = [(i, prose(i, 30)) for i in range(8)]
    assert sorted(tuple(r)[:5] for r in weighted(documents(spark, rows), none).collect()) == sorted(brute(rows, []))


def test_spans_are_those_of_overlapping_runs():
    flat = resampling.flat("A-b  c\nÄ")
    assert flat == "a b c Ä".encode()
    assert [[m.span() for m in run.finditer(flat, overlapped=True)] for run in resampling._RUNS] == [
        [(0, 1), (2, 3), (4, 5), (6, 8)], [(0, 3), (2, 5), (4, 8)]]
