"""Texts as arrays of lower-case letters, and hashed character n-grams of them."""

from __future__ import annotations

import sys

import numpy as np

from .tasks import once

SPACE = 32


def _letters() -> np.ndarray:
    """Code point to its lower-case letter; everything else is a space."""
    out = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters with single spaces between words, and a space at either end."""
    x = once("letters", _letters)[code_points(text)]
    x = np.concatenate(([SPACE], x, [SPACE])).astype(np.uint64)
    return x[np.r_[True, (x[1:] != SPACE) | (x[:-1] != SPACE)]]


def ngrams(x: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the `n`-gram at each place."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(x) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ x[i:len(x) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h
