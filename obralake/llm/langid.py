"""Language of whole texts: sparse multinomial regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .characters import letters, ngrams
from .tasks import add_columns

#: Hashed n-grams of 1 to 3 characters; one more feature is constant.
DIMS = 1 << 15
UNKNOWN = "und"


def _slots(text: str | None) -> np.ndarray:
    x = letters(text)
    if len(x) < 2:
        return np.zeros(0, np.int64)
    return (np.concatenate([ngrams(x, n) for n in (1, 2, 3)]) >> np.uint64(20)).astype(np.int64) % DIMS


def _counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    tf = np.bincount(_slots(text), minlength=DIMS)
    at = np.flatnonzero(tf)
    return at, tf[at]


def _weigh(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length, and the constant."""
    x = np.log1p(tf) * idf[at]
    length = np.sqrt(x @ x)
    return np.r_[at, DIMS], np.r_[x / length if length else x, 1.0]


def document_frequency(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Of every slot, over all rows; the table has DIMS numbers, however many rows there are."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, rows = np.zeros(DIMS, np.int64), 0
        for pdf in batches:
            for text in pdf[text_col]:
                seen = np.zeros(DIMS, bool)
                seen[_slots(text)] = True
                df += seen
                rows += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"slot": np.r_[at, -1], "n": np.r_[df[at], rows]})

    df, rows = np.zeros(DIMS, np.int64), 0
    for r in docs.select(text_col).mapInPandas(count, "slot long, n long").groupBy("slot").agg(
            F.sum("n").alias("n")).collect():
        if r.slot < 0:
            rows = r.n
        else:
            df[r.slot] = r.n
    return df, rows


def train(docs: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> dict:
    """Model from labelled rows: frequencies from all of them, weights from about `sample`, at most twice
    as many.

    Each label gives up to an equal share of the sample, chosen by a hash of id and text, so that copies
    of a text are chosen one by one; repeated rows count once in it, null texts not at all.
    """
    known = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    df, rows = document_frequency(known, text_col)
    idf = np.log((1 + rows) / (1 + df)) + 1
    sizes = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    labels = sorted(sizes)
    model = {"labels": labels, "idf": idf, "weights": np.zeros((max(1, len(labels)), DIMS + 1)), "t": 1.0}
    if not labels:
        return model
    share = sample / len(labels)
    kept = F.lit(False)
    for label in labels:
        limit = min(1.0, share / sizes[label])
        kept = kept | ((F.col(label_col) == label)
                       & (F.pmod(F.col("_hash"), F.lit(1 << 20)) < int(limit * (1 << 20)) + 1))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [_counts(t) for t in pdf[text_col]]
            yield pd.DataFrame({"_hash": pdf["_hash"], "label": pdf[label_col],
                                "at": [a.astype(np.uint16).tobytes() for a, _ in found],
                                "tf": [c.astype(np.uint32).tobytes() for _, c in found]})

    chosen = known.select(text_col, label_col, F.xxhash64(
        F.col(id_col).cast("string"), text_col).alias("_hash")).filter(kept).mapInPandas(
        features, f"_hash long, label {docs.schema[label_col].dataType.simpleString()}, at binary, tf binary")
    got = chosen.dropDuplicates(["_hash"]).orderBy("_hash").limit(2 * sample).collect()
    got.sort(key=lambda r: (bytes(r["at"]), bytes(r.tf), labels.index(r.label)))
    x = [_weigh(np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r.tf, np.uint32), idf)
         for r in got]
    y = np.array([labels.index(r.label) for r in got], int)
    held = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
    weights = ftrl.fit([r for r, h in zip(x, held) if not h], y[~held], len(labels), DIMS + 1,
                       l1=0.05, alpha=1.0)
    scores = np.array([weights[:, a] @ v for (a, v), h in zip(x, held) if h])
    return model | {"weights": weights, "t": ftrl.temperature(scores, y[held])}


def identify(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "lang", sample: int = 4000, keep: list[str] | None = None) -> DataFrame:
    """`lang_pred` and calibrated `score` of each document, by a model of `learn`'s labels.

    Follow-the-regularised-leader with elastic-net penalties fits the weights on about `sample`
    labelled rows (twice as many at most); a fifth of them sets the temperature. Texts that are null or have no letter are
    `und` with score 0, as is everything if nothing can be learned; repeated rows get a row each; ties
    go to the first label; `keep` names further columns to return.
    """
    model = train(learn, id_col, text_col, label_col, sample)
    labels, idf, weights, t = model["labels"], model["idf"], model["weights"], model["t"]

    def predict(texts: list[str | None]) -> list[list]:
        names, best = [], []
        for text in texts:
            at, tf = _counts(text)
            if not len(at) or not labels:
                names.append(UNKNOWN)
                best.append(0.0)
                continue
            at, x = _weigh(at, tf, idf)
            p = ftrl.softmax(weights[:, at] @ x / t)
            names.append(labels[int(p.argmax())])
            best.append(float(p.max()))
        return [names, best]

    return add_columns(docs, text_col, {"lang_pred": "string", "score": "double"}, predict,
                       [id_col, *(keep or [])])
