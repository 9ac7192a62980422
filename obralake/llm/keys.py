"""A non-null key of a row that has an id and a text, so that repeated and null ids stay apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows with equal id and text, different otherwise."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("~")),
                       F.hex(F.xxhash64(text_col)))
