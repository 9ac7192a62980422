"""Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq

import numpy as np


def difference(parts: np.ndarray) -> np.ndarray:
    """Merge partial partitions; returns the final lane of each lane of each part.

    `parts` holds one partial partition per row, a load for each of the k lanes. The two rows with
    the largest spread are merged again and again, the heavy lanes of one onto the light lanes of
    the other, until one is left. A single item is a row with its size in one lane, zero elsewhere.
    """
    n, k = parts.shape
    if n == 0:
        return np.zeros((0, k), np.int32)
    entry = np.argsort(parts, axis=1, kind="stable")
    loads = np.zeros((2 * n - 1, k), np.int64)
    loads[:n] = np.take_along_axis(parts, entry, axis=1)
    children = np.zeros((n - 1, 2), np.int64)
    ranks = np.zeros((n - 1, k), np.int32)
    heap = [(int(row[0] - row[-1]), i) for i, row in enumerate(loads[:n])]
    heapq.heapify(heap)
    lanes = np.arange(k, dtype=np.int32)
    for j in range(n, 2 * n - 1):
        _, a = heapq.heappop(heap)
        _, b = heap[0]
        merged = loads[a] + loads[b][::-1]
        order = np.argsort(merged, kind="stable")
        loads[j] = merged[order]
        ranks[j - n][order] = lanes
        children[j - n] = a, b
        heapq.heapreplace(heap, (int(loads[j, 0] - loads[j, -1]), j))
    place = np.zeros((2 * n - 1, k), np.int32)
    place[-1] = lanes
    for j in range(2 * n - 2, n - 1, -1):
        a, b = children[j - n]
        to = place[j][ranks[j - n]]
        place[a], place[b] = to, to[::-1]
    out = np.empty((n, k), np.int32)
    np.put_along_axis(out, entry, place[:n], axis=1)
    return out


def deal(sizes: np.ndarray, k: int) -> np.ndarray:
    """Lane of each item, for lanes of nearly equal load."""
    parts = np.zeros((len(sizes), k), np.int64)
    parts[:, 0] = sizes
    return difference(parts)[:, 0]
