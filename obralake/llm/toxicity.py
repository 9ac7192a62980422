"""Toxicity of whole texts after noisy-channel restoration of disguised words."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .characters import SPACE, code_points, letters, ngrams
from .tasks import add_columns, once

# Signs that stand for letters, and signs put between letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l", "¡": "i"}
BETWEEN = ".-_*~'`^,"
#: Letters of the character model: space, a to z, one for all others; n-grams of three.
ALPHABET = 28
#: Log costs of the channel: a sign for a letter, a sign left out, a repeated letter left out.
SIGN_COST, GAP_COST, REPEAT_COST = 0.5, 0.7, 0.2
#: Log costs of a word that is no disguise: a sign in it, a word's end that a sign between letters makes.
PLAIN_SIGN, PLAIN_GAP = 4.0, 0.5
#: Signs around words, but for those that stand for letters.
AROUND = ".,;:?\"'()[]{}<>%&#*-_~^`=/\\"
#: Lengths of the n-grams that score, the most that are kept, and the least z-score of the difference
#: between the labels' shares: beyond chance for some million n-grams.
LENGTHS, FEATURES, LEAST_Z = (4, 5, 6), 1 << 14, 5.5


def _model_letters(text: str | None) -> np.ndarray:
    x = letters(text)
    a = ord("a")
    return np.where(x == SPACE, 0, np.where((x >= a) & (x < a + 26), x - (a - 1), 27)).astype(np.int64)


def character_model(docs: DataFrame, text_col: str) -> np.ndarray:
    """Log probability of a letter after two others, from the trigrams of all texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(ALPHABET ** 3, np.int64)
        for pdf in batches:
            for text in pdf[text_col]:
                x = _model_letters(text)
                if len(x) > 2:
                    total += np.bincount((x[:-2] * ALPHABET + x[1:-1]) * ALPHABET + x[2:],
                                         minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    counts = np.zeros(ALPHABET ** 3)
    for r in docs.select(text_col).mapInPandas(count, "gram long, n long").groupBy("gram").agg(
            F.sum("n").alias("n")).collect():  # at most ALPHABET ** 3 rows
        counts[r.gram] = r.n
    counts = counts.reshape(ALPHABET, ALPHABET, ALPHABET)
    two = counts.sum(axis=0)
    one = two.sum(axis=0) + 1
    p = one / one.sum()
    p = (two + 50 * p) / (two.sum(axis=1, keepdims=True) + 50)
    p = (counts + 50 * p[None]) / (counts.sum(axis=2, keepdims=True) + 50)
    return np.log(p)


def decode(word: str, model: np.ndarray) -> str:
    """Most likely letters behind a disguised word: Viterbi over the lattice of its readings.

    A place of the lattice reads as a letter, a sign's letters, or nothing; a run of one letter reads
    as one or two of it. States are the last two letters, so the time is linear in the length.
    """
    return _best(word, model)[1]


def _best(word: str, model: np.ndarray, end_cost: float = 0.0) -> tuple[float, str]:
    """Score and letters of the best reading; `end_cost`, if given, is that of leaving out a sign at an end."""
    states: dict = {(0, 0): (0.0, None)}

    def step(old: dict, options: list[tuple[str, float]]) -> dict:
        new: dict = {}
        for (a, b), (score, out) in old.items():
            for text, cost in options:
                s, p, q = score - cost, a, b
                for c in text:
                    i = ord(c) - 96 if "a" <= c <= "z" else 27
                    s += model[p, q, i]
                    p, q = q, i
                if (p, q) not in new or new[p, q][0] < s:
                    new[p, q] = s, (out, text)
        return new

    runs = _runs(word)
    for at, (c, times) in enumerate(runs):
        if c.isalpha():
            options = [(c, REPEAT_COST * (times - 1)), *([(c * 2, REPEAT_COST * (times - 2))] if times > 1 else [])]
        else:
            options = [(x, SIGN_COST) for x in LEET.get(c, "")]
            options += [(x * 2, 2 * SIGN_COST) for x in LEET.get(c, "") if times > 1]
            if c in BETWEEN or c == " ":
                options.append(("", 0.1))
            elif not c.isdigit() or not options:
                out_cost = end_cost * min(times, 2) if end_cost and c in LEET and _at_end(runs, at) else GAP_COST
                options.append(("", out_cost))
        states = step(states, options)
    score, out = max(((s + model[k[0], k[1], 0], out) for k, (s, out) in states.items()), key=lambda x: x[0])
    parts = []
    while out:
        out, text = out
        parts.append(text)
    return score, "".join(reversed(parts))


def _runs(word: str) -> list[tuple[str, int]]:
    """Each sign of a word and how often it follows itself."""
    return [(c, sum(1 for _ in same)) for c, same in itertools.groupby(word)]


def _at_end(runs: list[tuple[str, int]], at: int) -> bool:
    """Whether a sign stands at either end of its word, exclamation marks in their own place aside."""
    return at == 0 and runs[at][0] != "¡" or at == len(runs) - 1 and runs[at][0] != "!"


def _plain(word: str, model: np.ndarray) -> float:
    """Score of a word that is what it looks like: signs end words, and signs for letters are rare."""
    x = np.r_[0, _model_letters(word)]
    runs = _runs(word)
    marks = {0: "¡", len(runs) - 1: "!"}
    cost = sum(PLAIN_SIGN * min(n, 2) if c in LEET and marks.get(i) != c else PLAIN_GAP * (c in BETWEEN)
               for i, (c, n) in enumerate(runs))
    return float(model[x[:-2], x[1:-1], x[2:]].sum()) - cost


def _kinds() -> np.ndarray:
    """Of each code point: 0 other, 1 letter, 2 sign for a letter, 3 sign between letters, 4 space."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        out[i] = 1 if c.isalpha() else 2 if c in LEET else 3 if c in BETWEEN else 4 if c.isspace() else 0
    return out


def _suspects(text: str) -> list[tuple[int, int]]:
    """Places of words that may be disguised, at white space and in order."""
    x = np.concatenate(([SPACE] * 3, code_points(text), [SPACE] * 3))
    kind = once("kinds", _kinds)[x]
    letter, sign, gap, space = kind == 1, kind == 2, kind == 3, kind == 4
    word = letter | sign | gap
    mark = np.zeros(len(x), bool)
    a, b, c, d = slice(0, -3), slice(1, -2), slice(2, -1), slice(3, None)
    # A sign beside a letter or another sign; a sign between two of them; a run of three letters; single
    # letters with spaces between.
    mark[b] |= sign[b] & (word[a] | word[c])
    mark[b] |= gap[b] & word[a] & word[c]
    mark[b] |= letter[a] & (x[a] == x[b]) & (x[b] == x[c])
    mark[b] |= space[a] & (letter | sign)[b] & space[c] & (letter | sign)[d]
    at = np.flatnonzero(mark)
    if not len(at):
        return []
    edges = np.flatnonzero(space)
    single = np.zeros(len(x), bool)
    single[1:-1] = space[:-2] & (letter | sign)[1:-1] & space[2:]
    # Only words with a letter: so many letters stand before each place.
    before = np.r_[0, np.cumsum(letter)]
    spans: list[tuple[int, int]] = []
    done = 0
    for i in at:
        if i < done:
            continue
        if single[i]:
            first, last = i, i + 1
            while last + 1 < len(x) and x[last] == SPACE and single[last + 1]:
                last += 2
            least = 5
        else:
            edge = np.searchsorted(edges, i)
            first, last = edges[edge - 1] + 1, edges[edge]
            least = 3
        done = last
        if last - first >= least and before[last] > before[first]:
            spans.append((int(first) - 3, int(last) - 3))
    return spans


def restore(text: str | None, model: np.ndarray) -> str:
    """The text with disguised words in plain letters; other words stay.

    A word with signs counts as disguised if the model likes its best reading better than the word as
    it stands, whatever its length; one with a run of three equal letters always does.
    """
    text = text or ""
    out, done = [], 0
    for first, last in _suspects(text):
        kept = text[first:last].lower().strip(AROUND)
        core = kept.rstrip("$") if kept.endswith("$$$") else kept
        runs = _runs(core)
        if sum(min(n, 2) for c, n in runs if c.isalpha() or c in LEET) < 3:
            continue
        stretched = any(n > 2 and c.isalpha() for c, n in runs)
        if core.isalpha() and not stretched or not any(c.isalpha() for c in core):
            continue
        score, plain = _best(core, model, PLAIN_SIGN)
        if plain == core.strip("".join(LEET) + AROUND) or not stretched and score <= _plain(core, model):
            continue
        out += [text[done:first], plain, " "]
        done = last
    return "".join(out) + text[done:]


def _grams(text: str) -> np.ndarray:
    x = letters(text)
    return np.concatenate([ngrams(x, n) for n in LENGTHS])


class _Scorer:
    """Weights of a few n-grams, found through a table of their low bits."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray | None = None):
        self.grams = np.sort(grams)
        self.weights = weights[np.argsort(grams)] if weights is not None else None
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.grams & np.uint64((1 << 20) - 1)] = True

    def present(self, text: str) -> np.ndarray:
        h = _grams(text)
        h = np.unique(h[self.bits[h & np.uint64((1 << 20) - 1)]])
        at = np.searchsorted(self.grams, h)
        at[at == len(self.grams)] = 0
        return at[self.grams[at] == h] if len(self.grams) else at[:0]


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, id_col: str, text_col: str,
          label_col: str, sample: int) -> tuple[np.ndarray, np.ndarray, float]:
    """N-grams with their weights, and the constant, from about `sample` labelled rows.

    Half of the sample is taken from either label, chosen by a hash of the id; the constant is then
    moved to the labels' true ratio. Of the sample's n-grams those that tell the labels apart beyond
    chance are kept (at most FEATURES, the best first).
    """
    none = np.zeros(0, np.uint64), np.zeros(0), 0.0
    marked = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(label_col).cast("int").alias("_y"))
    sizes = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return none
    part = F.pmod(F.xxhash64(id_col), F.lit(1 << 20))
    share = {y: min(1.0, sample / 2 / n) for y, n in sizes.items()}
    chosen = marked.filter(part < F.when(F.col("_y") == 1, int(share[1] * (1 << 20)) + 1).otherwise(
        int(share[0] * (1 << 20)) + 1))
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # about `sample` rows

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for y, text in zip(pdf["_y"], pdf[text_col]):
                grams = np.unique(_grams(restore(text, model)))
                yield pd.DataFrame({"gram": grams.view(np.int64), "one": np.int64(y),
                                    "zero": np.int64(1 - y)})

    counts = rows.mapInPandas(spread, "gram long, one long, zero long").groupBy("gram").agg(
        F.sum("one").alias("one"), F.sum("zero").alias("zero"))
    totals = [r["count"] for r in rows.groupBy("_y").count().orderBy("_y").collect()]
    if len(totals) < 2:
        return none
    share_of = (F.col("one") + F.col("zero") + 1) / float(sum(totals) + 2)
    z = F.abs(F.col("one") / totals[1] - F.col("zero") / totals[0]) / F.sqrt(
        share_of * (1 - share_of) * (1 / totals[0] + 1 / totals[1]))
    best = counts.filter(F.col("one") + F.col("zero") > 2).withColumn("z", z).filter(
        F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "gram").limit(FEATURES)
    grams = np.array([r.gram for r in best.select("gram").collect()], np.int64).view(np.uint64)
    scorer = _Scorer(grams)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf[id_col].astype(str), "y": pdf["_y"], "at": [
                scorer.present(restore(t, model)).astype(np.int32).tobytes() for t in pdf[text_col]]})

    got = sorted(rows.mapInPandas(present, "id string, y int, at binary").collect(),
                 key=lambda r: (r.id, bytes(r["at"])))
    x = []
    for r in got:
        at = np.r_[np.frombuffer(r["at"], np.int32).astype(np.int64), len(grams)]
        x.append((at, np.ones(len(at))))
    y = np.array([r.y for r in got], int)
    w = ftrl.fit(x, y, 2, len(grams) + 1, l1=0.5, l2=0.01, alpha=0.3, epochs=8)
    w = w[1] - w[0]
    shift = math.log(sizes[1] / sizes[0] * totals[0] / totals[1])
    kept = np.flatnonzero(w[:-1])
    return scorer.grams[kept], w[kept], float(w[-1] + shift)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample: int = 6000,
                   learn: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """`score` (0 to 1) and `predicted` of each document, learned from `labels`.

    Disguised words are restored first: signs for letters, letters apart and repeated letters make a
    lattice, and Viterbi finds the reading that a character model of all texts likes best. Then n-grams
    of the restored text are scored by a sparse logistic regression. `learn` are the documents whose
    texts may be learned from (default: `docs`); about `sample` labelled ones fit the weights.

    Null and empty texts get the score of a text without any known n-gram; repeated rows get a row
    each; without both labels every score is 0; `keep` names further columns to return.
    """
    model = character_model(docs, text_col)
    grams, weights, constant = train(docs if learn is None else learn, labels, model, id_col, text_col,
                                     label_col, sample)
    scorer = _Scorer(grams, weights)

    def predict(texts: list[str | None]) -> list[list]:
        scores = []
        for text in texts:
            s = constant + scorer.weights[scorer.present(restore(text, model))].sum()
            scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, s)))) if len(grams) else 0.0)
        return [scores, [int(s >= 0.5) for s in scores]]

    return add_columns(docs, text_col, {"score": "double", "predicted": "int"}, predict,
                       [id_col, *(keep or [])])


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", sample: int = 6000) -> DataFrame:
    """The documents, all columns, that the model does not call toxic."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # theirs may be those of the result
    name = dict(zip(docs.columns, names))
    scored = score_toxicity(
        docs.toDF(*names), labels.withColumnRenamed(id_col, name[id_col]), name[id_col], name[text_col],
        label_col, sample, keep=[n for n in names if n != name[id_col]])
    return scored.filter(F.col("predicted") == 0).select(*names).toDF(*docs.columns)
