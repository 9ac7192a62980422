import itertools

import numpy as np
import pytest

from obralake.llm import jaccard
from obralake.llm.components import components
from obralake.llm.jaccard import keep_one_of_each, link_documents

from .common import documents, prose


def shingles(text, size=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=90, size=3, order=str):
    sets = [shingles(t, size) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    found = [(rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0], links[i]) for i in range(len(rows))]
    return sorted(found, key=order) if order else found


def edited(text, *places):
    w = text.split()
    for p in places:
        w[p % len(w)] = f"edit{p}"
    return " ".join(w)


def near_copies():
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, "two\tWORDS"), (6, "Ä b c"), (7, "ä b c"),
            (8, "a b c d"), (9, "A B C D"), (9, "A B C D"), (None, "a b c d"), (None, "only me here")]
    for g in range(8):
        base = prose(g, 12 + 40 * g)
        rows += [(100 * g + 50 + i, edited(base, *range(i, i + i % 4 * 7, 7))) for i in range(9)]
    long = prose(99, 3000)
    rows += [(2000 + i, edited(long, *range(i * 37, i * 37 + 15 * i))) for i in range(8)]
    line = prose(7, 60)
    return rows + [(3000 + i, line + " " + prose(500 + i, 5 + i % 9)) for i in range(60)]


@pytest.mark.parametrize("unit, boundary", [(512, None), (8, None), (512, 3)])
def test_links_match_brute_force(spark, monkeypatch, unit, boundary):
    monkeypatch.setattr(jaccard, "UNIT", unit)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BUCKET", 3000)
    if boundary:
        monkeypatch.setattr(jaccard, "_boundary", lambda sets: boundary)
    rows = near_copies()
    got = link_documents(documents(spark, rows, "no long, n string, node int").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_one_of_each_stays(spark):
    rows = near_copies()
    kept = keep_one_of_each(documents(spark, rows)).collect()
    # The row without an id that is a copy of others goes, the one that is alone stays.
    want = sorted((i for (i, t), (_, n, c, _) in zip(rows, brute(rows, order=None)) if n == 0 or i == c or t == "only me here"),
                  key=str)
    want.remove(9) if want.count(9) == 2 else None
    assert sorted((r.doc_id for r in kept), key=str) == want
    assert kept[0].pos == "p"


def test_rows_are_told_apart_by_id_and_text(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (2, b), (2, edited(a, 5)), (3, edited(b, 9)), (None, c), (None, edited(c, 3)), (None, c), (10, c + " x"),
            (9, c + " y")]
    kept = keep_one_of_each(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (2, b), (9, c + " y")]
    kept = keep_one_of_each(documents(spark, [(None, c), (None, edited(c, 3)), (None, c), (4, None), (4, None)])).collect()
    assert len([r for r in kept if r.doc_id is None]) == 1 and len(kept) == 3


def test_texts_that_share_a_line_are_read_once(spark, monkeypatch):
    """Only sets that have enough of their first elements in common go on to the second reading."""
    counted, real = [], jaccard.store
    monkeypatch.setattr(jaccard, "store", lambda df, name: [out := real(df, name), name == "counted" and counted.append(
        out.filter("no is not null").count())][0])
    rows = [(i, prose(i, 300) + " a line that all of these texts have and no more than that " + prose(99 - i, 300)) for i in range(40)]
    rows += [(100 + i, edited(t, 5, 200)) for i, t in rows[:3]]
    got = link_documents(documents(spark, rows), 80, 5).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 80, 5)
    assert counted == [6]


@pytest.mark.parametrize("percent", [5, 50, 80, 90, 100])
def test_linked_sets_have_first_elements_in_common(percent):
    rng = np.random.default_rng(percent)

    def first(x):
        n = np.array(len(x))
        return np.sort(x)[:int(n - jaccard.required(n, percent) + jaccard.in_common(n, percent))]

    met = 0
    for n in [*range(1, 60), 199, 1000]:
        for both in {int(jaccard.required(np.array(n), percent)), n - n // 20, n}:
            x = rng.permutation(4 * n + 4)
            a, b = x[:n], np.r_[x[:both], x[n:n + int(rng.integers(0, n))]]
            if 100 * both >= percent * len(np.union1d(a, b)):
                met += 1
                for s in (a, b):
                    assert len(np.intersect1d(first(a), first(b))) >= jaccard.in_common(jaccard.required(np.array(len(s)), percent), percent)
    assert met >= 5


@pytest.mark.parametrize("kind", ["light", "mixed", "heavy"])
def test_boundary_is_the_one_with_the_least_work(spark, kind):
    """Sets of two elements ask for subsets, sets of many for lists, and both for both."""
    hot = [[k % 3, 3 + k % 5] for k in range(400)]
    wide = [list(range(10_000 + 500 * (k // 2), 10_300 + 500 * (k // 2))) for k in range(8)]
    rows = {"light": hot, "heavy": wide, "mixed": hot + wide}[kind]
    sets = spark.createDataFrame([(bytes([i // 256, i % 256]), len(x), x) for i, x in enumerate(rows)],
                                 "node binary, reach int, shared array<long>")
    found = jaccard._boundary(sets)
    assert {"light": found >= 2, "heavy": found == 0, "mixed": 2 <= found < 300}[kind]


@pytest.mark.parametrize("kind", ["light", "mixed", "heavy"])
def test_links_with_the_boundary_found(spark, monkeypatch, kind):
    """Short texts of few words, long texts with few copies, and both, against brute force."""
    rng = np.random.default_rng(1)
    short = [(i, " ".join(rng.choice(list("abc"), 11))) for i in range(150)]
    short += [(200 + i, edited(t, 3)) for i, t in short[:9]]
    long = [(500 + i, edited(prose(70 + i // 2, 900), *range(i % 2 * 40, 0, -1))) for i in range(8)]
    rows = {"light": short, "heavy": long, "mixed": short + long}[kind]
    seen, real = [], jaccard._boundary
    monkeypatch.setattr(jaccard, "_boundary", lambda sets: seen.append((real(sets), sets.agg({"reach": "max"}).first()[0])) or seen[-1][0])
    got = link_documents(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    found, most = seen[0]
    assert {"light": found >= most, "heavy": found == 0, "mixed": 0 < found < most}[kind], seen


def test_empty_table(spark):
    assert link_documents(documents(spark, [])).collect() == []


def test_no_links_at_all(spark):
    rows = [(i, prose(i, 30)) for i in range(20)]
    got = link_documents(documents(spark, rows)).collect()
    assert all(r.component_id == r.doc_id and r.n_links == 0 for r in got)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}
