import numpy as np
import pytest

from obralake.llm.mtree import MTree, top_inner_products
from obralake.llm.preferences import format_preferences


def vectors(n=900, dim=12, groups=9):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(groups, dim))
    return (centres[rng.integers(0, groups, n)] + 0.1 * rng.normal(size=(n, dim))).astype(np.float32)


def brute(rows, asked, k):
    out = []
    ints = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows.items()}
    for q in asked:
        scored = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("tree_rows, block", [(None, 2048), (100, 20)])
def test_search_matches_brute_force(spark, tree_rows, block):
    v = vectors()
    rows = {i: x.tolist() for i, x in enumerate(v)}
    for i in range(1000, 1300):  # a third are one vector
        rows[i] = rows[5]
    rows[2000] = [0.0] * 12
    odd = [(3000, None), (3001, [float("nan")] * 12), (3002, [None] + [0.0] * 11), (3003, [float("inf")] * 12),
           (None, [1.0] * 12), (5, rows[5]), (3004, [1.0, 2.0]), (3005, [2.0, 2.0])]
    table = spark.createDataFrame([*[(i, x) for i, x in rows.items()], *odd], "vec_id long, embedding array<float>")
    table = table.selectExpr("*", "1 AS id", "2 AS v", "3 AS tree")
    asked = [i for i in rows if i % 50 == 0] + [3005]
    got = top_inner_products(table, table.filter("vec_id % 50 = 0 or vec_id = 3005"), 5, tree_rows=tree_rows, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows | {3004: [1.0, 2.0], 3005: [2.0, 2.0]}, asked, 5)


def test_scores_of_any_size_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = {i: [float(x) for x in rng.integers(-3, 4, 3) * 10.0 ** rng.integers(0, 9)] for i in range(150)}
    rows |= {200 + i: [1e6 + i / 256, 1e6, 1e6, 1e6][:3] for i in range(9)} | {300: [-1e6, 1e6, 3e6], 301: [5e8, -5e8, 1.0]}
    table = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows.items()}
    want = []
    for q in (i for i in rows if i % 25 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
        want += [(q, r, i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, i) in enumerate(scored[:4], 1)]
    for tree_rows in (None, 30):
        got = top_inner_products(table, table.filter("vec_id % 25 = 0"), 4, tree_rows=tree_rows)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert max(abs(s) for _, _, _, s in want) == 2 ** 63 - 1


def test_subtrees_without_room_are_not_visited(spark):
    """Of rows in tight groups, a query meets few subtrees besides its own."""
    v = vectors(3000, 8, 12)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = top_inner_products(table, table.filter("vec_id % 100 = 0"), 5, tree_rows=60).collect()
    assert sorted(map(tuple, got)) == brute({i: x.tolist() for i, x in enumerate(v)}, range(0, 3000, 100), 5)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_inner_products(none, none).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_inner_products(one, one).collect() == []
    assert top_inner_products(one, none).collect() == []


def test_bounds_avoid_most_distances():
    rows = (256 * vectors(4000, 8, 40)).astype(np.int64)
    tree = MTree(np.arange(len(rows)), rows)
    shares = []
    for q in rows[::400]:
        found, computed = tree.search(q, 5, None)
        want = sorted(((int(s), -i) for i, s in enumerate(rows @ q)), reverse=True)[:5]
        assert found == [(s, -i) for s, i in want]
        shares.append(computed / len(rows))
    assert np.mean(shares) < 0.5


def test_pages_are_bounded_and_cover_their_rows():
    rows = (256 * vectors(1000)).astype(np.int64)
    tree = MTree(np.arange(len(rows)), rows)
    leaves = [p for p in tree.pages if p[0]]
    assert sorted(i for p in leaves for i in p[1]) == list(range(1000))
    assert all(len(p[1]) <= 64 for p in tree.pages)


def render(turns):
    text, spans = "", []
    for role, t in turns:
        text += f"<|{role}|>\n"
        start = len(text)
        text += f"{t}<|end|>\n"
        if role == "assistant":
            spans.append((start, len(text)))
    return text, spans


def test_preferences(spark):
    u, a = "user", "assistant"
    pairs = {
        1: ([(u, "hi"), (a, "good"), (u, "é😀")], [(u, "hi"), (a, "bad")]),
        2: ([(u, "same"), (a, "x")], [(u, "same"), (a, "x")]),
        3: ([(u, "only")], []),
        4: ([], [(a, "only")]),
        5: ([(u, "p"), (a, "q")], [(u, "p"), (a, "q"), (u, "more"), (a, "end")]),
        6: ([("", ""), (a, "x" * 50_000)], [("", ""), (a, "y")]),
        7: ([(u, f"t{i}") for i in range(200)], [(u, f"t{i}") for i in range(150)] + [(a, "z")]),
        8: ([(u, "r"), (u, "r")], [(u, "r")]),
    }
    rows = [(p, side == 0, n, role or None, text or None, "k", 1) for p, both in pairs.items()
            for side, turns in enumerate(both) for n, (role, text) in enumerate(turns)]
    rows += [(None, True, 0, u, "lost", "k", 1), (9, None, 0, u, "lost", "k", 1)]
    table = spark.createDataFrame(rows, "pair_id long, chosen boolean, turn int, role string, text string, prompt string, n int")
    got = {r.pair_id: r for r in format_preferences(table.repartition(4)).collect()}
    assert set(got) == set(pairs)
    for p, (c, r) in pairs.items():
        n = next((i for i, (x, y) in enumerate(zip(c, r)) if x != y), min(len(c), len(r)))
        assert (got[p].n_prompt, got[p].prompt) == (n, render(c[:n])[0])
        for turns, text, spans in ((c, got[p].chosen, got[p].chosen_spans), (r, got[p].rejected, got[p].rejected_spans)):
            want, places = render(turns[n:])
            assert text == want and [tuple(s) for s in spans] == places
    assert format_preferences(table.limit(0)).collect() == []
