"""Centroid clustering against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from obralake.llm.centroids import MOST, Centroids, cluster


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def brute(rows, k, rounds, size, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size
            and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-MOST - 1, min(MOST, x)) for x in v]) for i, v in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    places = [v for _, v in order[:k]]
    near = lambda v: min((squared(v, p), c) for c, p in enumerate(places))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for c, held in groups.items():
            places[c] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    sums = [sum(d for _, c, d in found if c == o) for o in range(len(places))]
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in places]
    end = lambda x: min(x, MOST)
    return [(i, c, end(d), end(sums[c]), end(sum(map(end, (d for _, _, d in found)))), digest[c])
            for i, c, d in found]


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, cluster int, id string").repartition(3)


def made(seed, n, size=4):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=size) + 3 * (i % 5)).tolist()) for i in range(n)]
    bad = [(900, None), (901, []), (902, [1.0] * (size + 1)), (903, [None] + [1.0] * (size - 1)),
           (904, [math.nan] * size), (905, [math.inf] * size), (None, [0.5] * size)]
    return rows + bad + [(7, rows[7][1])] * 4 + [(950 + i, [1.0] * size) for i in range(6)]


def test_clusters_match_brute_force(spark):
    for seed in (1, 2):
        rows = made(seed, 120)
        got = cluster(table(spark, rows), k=8, rounds=4, size=4).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute(rows, 8, 4, 4), key=str)


def test_fewer_vectors_than_centroids_ties_and_empty_tables(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0])]
    got = cluster(table(spark, rows), k=8, rounds=3, size=2).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 8, 3, 2))
    assert cluster(table(spark, []), size=2).collect() == []
    assert cluster(table(spark, [(1, [1.0])]), size=2).collect() == []


def test_components_of_any_size(spark):
    rows = [(i, [x, -x / 3, 1.0]) for i, x in enumerate([1e5, 3e6, 2.5e9, 1e12, 4e12, 3e15, 1e300, -7e9])]
    got = cluster(table(spark, rows), k=3, rounds=2, size=3).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 3, 2, 3))


@pytest.mark.parametrize("size", [1, 2, 64])
def test_search_is_exact_and_leaves_distances_out(size):
    rng = np.random.default_rng(size)
    places = rng.integers(-900, 900, (40, size)) + rng.integers(-900, 900, (40, 1))
    places[7] = places[3]
    rows = np.r_[places[rng.integers(0, 40, 3000)] + rng.integers(-90, 90, (3000, size)), places]
    number, distance, computed = Centroids(places.tolist()).nearest(rows)
    every = ((rows[:, None] - places[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < 0.4 * every.size
