"""Small helpers for code that runs inside tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def once(name: str, build: Callable[[], Any]) -> Any:
    """`build()` once per worker process; library code travels by value, so globals don't last."""
    kept = sys.__dict__.setdefault("_obralake_once", {})
    if name not in kept:
        kept[name] = build()
    return kept[name]


def vocabulary(name: str, build: Callable[[], Any]) -> Any:
    """As `once`, for what grows with the words seen: a worker keeps that of one operator only."""
    kept = sys.__dict__.setdefault("_obralake_once", {})
    held = kept.get("vocabulary")
    if held is None or held[0] != name:
        kept["vocabulary"] = None  # free the old one first
        release()
        kept["vocabulary"] = held = (name, build())
    return held[1]


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def add_columns(rows: DataFrame, text_col: str, added: dict[str, str],
                compute: Callable[[list[str | None]], list[list]], keep: list[str]) -> DataFrame:
    """The columns `keep` of `rows` as they are, and those that `compute` makes of the texts of a batch.

    `added` gives the new columns' types. Kept columns stay Arrow data, so no value changes; their
    names may be those of new ones.
    """
    names = [f"k{i}" for i in range(len(keep))]
    new = [f"n{i}" for i in range(len(added))]
    fields = [f"{n} {rows.schema[c].dataType.simpleString()}" for n, c in zip(names, keep)]
    fields += [f"{n} {kind}" for n, kind in zip(new, added.values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = compute(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, results, types)], names=[*names, *new])
        release()

    types = [to_arrow_type(T.DataType.fromDDL(kind)) for kind in added.values()]
    packed = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)],
                         F.col(f"`{text_col}`").alias("text"))
    return packed.mapInArrow(run, ", ".join(fields)).toDF(*keep, *added)
