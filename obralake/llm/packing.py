"""Fixed-length token sequences by Karmarkar-Karp differencing."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .differencing import deal
from .tasks import release, vocabulary

#: Whole sequences that are handed on at once.
FULL = 512
#: Words whose ids a worker keeps; frequent words come early, so the first ones stay.
KEPT_WORDS = 150_000
# Fixed value: the pattern that belongs to the vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _letters() -> dict[str, int]:
    """Byte of each character that stands for one in a byte-level vocabulary: printable bytes stand for
    themselves, the others are numbered from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of byte strings and ids of special tokens of a byte-level BPE file (JSON)."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    byte = _letters()
    vocabulary = data["model"]["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in data["model"]["merges"]]
    numbers = [vocabulary[m] for m in merged]
    if numbers != sorted(numbers) or any(t[k] for t in data["added_tokens"] for k in (
            "lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path}: ids must follow the merges, and special tokens stand as they are")
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}, special


class WordEncoder(dict):
    """Byte-level BPE ids as little-endian uint32 bytes, encoded word by word.

    The pattern never matches across the border between a non-space and a space, so a text without
    two spaces in a row splits at its spaces; other texts, and those with the string of a special
    token, are encoded whole. `path` is a tokenizer's JSON file.
    """

    def __init__(self, path: str):
        super().__init__()
        ranks, self.special = read_vocabulary(path)
        self.encoder = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks,
                                         special_tokens=self.special)

    def ids(self, text: str) -> bytes:
        return np.array(self.encoder.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.ids(" " + word)
        if len(self) < KEPT_WORDS:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.encoder.encode(text, allowed_special="all"), "<u4").tobytes()
        if "  " in text:
            return self.ids(text)
        first, *rest = text.split(" ")
        return (self.ids(first) if first else b"") + b"".join(map(self.__getitem__, rest))


def windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece: as few windows as hold the total, one more while one overflows."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        lane = deal(lengths, k)
        if np.bincount(lane, lengths, k).max() <= capacity:
            return lane
        k += max(1, k // 200)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, grain: int = 512,
         block: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack token ids of whole texts, each closed by `end_id`, into sequences of at most `capacity`.

    A document fills whole sequences first; its rest is cut into pieces of `grain` ids or fewer, and
    each `block` of pieces is dealt by differencing to windows of nearly equal length. Work stays in
    the task that reads a document: nothing is shuffled, and a task that runs again gives the same
    sequences. Windows mix only documents of one input partition.

    Columns: the id, `start` and `length` of the piece in its document, `input_ids` (little-endian
    uint32), `doc_tokens`, `sequence_id`, `offset`. Null and empty texts are one `end_id`; repeated
    rows are packed each; an empty table gives no rows; other columns are not read. `tokenizer` is a
    file that all executors have.
    """
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(f"ids {tokenizer}", lambda: WordEncoder(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        full: list[tuple] = []
        rest: list[tuple] = []

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, tokens, seq, offset = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, ids_type), pa.array(start, pa.int64()),
                 pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(tokens, pa.int64()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                names=[id_col, "start", "length", "input_ids", "doc_tokens", "sequence_id", "offset"])

        def dealt() -> pa.RecordBatch:
            nonlocal sequence
            lengths = np.array([len(p[2]) // 4 for p in rest])
            lane = windows(lengths, capacity)
            used = np.zeros(lane.max() + 1, np.int64)
            number = np.cumsum(np.bincount(lane) > 0) - 1
            out = []
            for i in np.argsort(lane, kind="stable"):
                w = lane[i]
                out.append((*rest[i], sequence + int(number[w]), int(used[w])))
                used[w] += lengths[i]
            sequence += int(number[-1]) + 1
            return rows(out)

        for batch in batches:
            ids_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                tokens = len(ids) // 4
                whole = tokens - tokens % capacity
                for at in range(0, whole, capacity):
                    full.append((doc, at, ids[4 * at:4 * (at + capacity)], tokens, sequence, 0))
                    sequence += 1
                for at in range(whole, tokens, grain):
                    rest.append((doc, at, ids[4 * at:4 * (at + grain)], tokens))
                if len(full) >= FULL:
                    yield rows(full)
                    full = []
                if len(rest) >= block:
                    yield dealt()
                    rest = []
        if full:
            yield rows(full)
        if rest:
            yield dealt()
        release()

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type.simpleString()}, start long, length long, input_ids binary, "
             "doc_tokens long, sequence_id long, offset long")
