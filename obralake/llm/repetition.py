"""Quality rules on repetition inside a text, by suffix arrays of its words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import add_columns

#: Words of a repeat that counts, the most of a text that such repeats may cover, in percent, and the
#: longest repeat in words.
LEAST, COVERED, LONGEST = 10, 30, 100
#: Base rules: least words, words of a window, and the most of the words in windows found twice, in percent.
LEAST_WORDS, WINDOW, REPEATED = 50, 3, 50
# Characters that count as symbols, and those between words.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"
#: Words whose texts share one suffix array; a longer text has one of its own.
GATHERED = 1 << 16


def suffix_array(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes, each of which ends with its own text.

    `codes` are the words of texts put one after another, `doc` their texts' numbers, ascending.
    Prefixes are doubled; only suffixes that are still tied are sorted again.
    """
    n = len(codes)
    end = np.searchsorted(doc, doc, "right")
    key = doc * (codes.max(initial=0) + 1) + codes
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)  # place of the first suffix with an equal prefix
    rank[sa] = _first_of_run(key[sa])
    at = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    width = 1
    while len(at):
        after = at + width
        inside = after < end[at]
        key = rank[at] * (n + 1)
        key[inside] += rank[after[inside]] + 1
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        old = rank[at]
        place = old + np.arange(len(at)) - _first_of_run(old)
        new = place[_first_of_run(key)]
        sa[place] = at
        rank[at] = new
        tied = np.r_[new[1:] == new[:-1], False]
        at = at[tied | np.r_[False, tied[:-1]]]
        width *= 2
    return sa


def _first_of_run(values: np.ndarray) -> np.ndarray:
    """For each entry of a sorted array, the index of the first one that equals it."""
    first = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    return np.maximum.accumulate(np.where(first, np.arange(len(values)), 0)) if len(values) else values


def common_prefixes(codes: np.ndarray, doc: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the words its suffix shares with the one before it in `sa`, within one text.

    A suffix whose preceding word equals that of its neighbour shares one word less than the suffix
    before it in the text; only the others are compared, and their lengths sum to n log n at most.
    """
    n = len(codes)
    near = np.full(n, -1)
    near[sa[1:]] = sa[:-1]
    near[(near >= 0) & (doc[near] != doc)] = -1
    has = near >= 0
    left = np.zeros(n, bool)  # the words before both are equal and in the text
    inner = np.flatnonzero(has & (near > 0) & (np.arange(n) > 0))
    left[inner] = ((codes[inner - 1] == codes[near[inner] - 1]) & (doc[inner - 1] == doc[inner])
                   & (doc[near[inner] - 1] == doc[inner]))
    shared = np.zeros(n, np.int64)
    at = np.flatnonzero(has & ~left)
    end = np.searchsorted(doc, doc[at], "right")
    most = end - np.maximum(at, near[at])
    for step in range(16):
        open_ = most > step
        at, most = at[open_], most[open_]
        equal = codes[at + step] == codes[near[at] + step]
        at, most = at[equal], most[equal]
        shared[at] = step + 1
        if not len(at):
            break
    for i, limit in zip(at.tolist(), most.tolist()):  # long ones, in blocks of growing size
        j, done, block = int(near[i]), 16, 16
        while done < limit:
            size = min(block, limit - done)
            differ = np.flatnonzero(codes[i + done:i + done + size] != codes[j + done:j + done + size])
            if len(differ):
                done += int(differ[0])
                break
            done, block = done + size, block * 2
        shared[i] = done
    source = np.maximum.accumulate(np.where(left, 0, np.arange(n)))
    return np.where(left, shared[source] - (np.arange(n) - source), shared)


def longest_repeats(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position, the words from there on that occur elsewhere in the text too.

    The deepest interval of common prefixes that holds a suffix gives it: the longer one of what the
    suffix shares with its two neighbours in the suffix array.
    """
    if not len(codes):
        return np.zeros(0, np.int64)
    sa = suffix_array(codes, doc)
    before = common_prefixes(codes, doc, sa)
    reach = before.copy()
    reach[sa[:-1]] = np.maximum(reach[sa[:-1]], before[sa[1:]])
    return reach


def covered(reach: np.ndarray, least: int) -> np.ndarray:
    """Whether a word lies in a maximal repeat of `least` words or more: the union of their spans."""
    n = len(reach)
    maximal = reach >= least
    maximal[1:] &= reach[1:] >= reach[:-1]  # else the repeat that begins one word earlier holds it
    begin = np.flatnonzero(maximal)
    change = np.bincount(begin, minlength=n + 1) - np.bincount(begin + reach[begin], minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _spans(inside: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    return [{"first": a, "last": b} for a, b in edges.reshape(-1, 2).tolist()]


def _measured(texts: list[str | None]) -> list[tuple]:
    """`n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, covered words, longest
    repeat and covered spans of each text."""
    out: list[tuple] = []
    group: list[tuple[str, list[bytes]]] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        known: dict[bytes, int] = {}
        codes = np.array([known.setdefault(w, len(known)) for _, words in group for w in words], np.int64)
        sizes = [len(words) for _, words in group]
        reach = longest_repeats(codes, np.repeat(np.arange(len(group)), sizes))
        at = 0
        for (text, words), n in zip(group, sizes):
            own = reach[at:at + n]
            at += n
            inside = covered(own, LEAST)
            lines = [x for x in text.split("\n") if x.strip(SPACES)]
            out.append((n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
                        len(lines) - len(set(lines)), int(covered(own, WINDOW).sum()),
                        int(inside.sum()), int(own.max(initial=0)), _spans(inside)))
        group, held = [], 0

    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if group and held + len(words) > GATHERED:
            flush()
        group.append((text or "", words))
        held += len(words)
    flush()
    return out


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """Repetition of each document, and whether the rules keep it.

    A suffix array of the words, with the lengths of the prefixes that neighbours share, gives the
    maximal repeated passages of a text; passages may overlap. A text is kept if it has LEAST_WORDS
    words, at most REPEATED percent of them in windows of WINDOW words found twice (`base_failed` says
    so), at most COVERED percent in repeats of LEAST words or more, and no repeat of more than LONGEST
    words.

    Columns: the id, `keep`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`,
    `base_failed`, `n_covered_words`, `longest_repeat`, `repeats` (covered word positions, `last`
    exclusive), `kept`. Null and empty texts have no words and fail; every row gets a row, repeated
    ones too; a text of any length is read whole, with memory in proportion to its words; an empty
    table gives no rows; nothing is shuffled and other columns are not read.
    """
    added = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
             "n_repeat_words": "long", "n_covered_words": "long", "longest_repeat": "long",
             "repeats": "array<struct<first:long,last:long>>"}

    def compute(texts: list[str | None]) -> list[list]:
        return [list(c) for c in zip(*_measured(texts))] if texts else [[] for _ in added]

    kept = [id_col, *(keep or [])]
    found = add_columns(docs, text_col, added, compute, kept).toDF(
        *[f"k{i}" for i in range(len(kept))], *added)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    good = ~failed & (100 * F.col("n_covered_words") <= COVERED * F.col("n_words")) & (
        F.col("longest_repeat") <= LONGEST)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], *list(added)[:5],
                        failed.alias("base_failed"), *list(added)[5:], good.alias("kept"))


def without_repetition(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that the rules keep."""
    plain = [f"c{i}" for i in range(len(docs.columns))]
    text = plain[docs.columns.index(text_col)]
    return repetition(docs.toDF(*plain), plain[0], text, plain[1:]).filter("kept").select(
        *plain).toDF(*docs.columns)
