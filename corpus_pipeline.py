"""Training corpus from `documents`: toxic texts, near copies and benchmark leaks go, personal data is
replaced, and what stays is packed into token sequences.

Each stage takes all documents that its predecessor kept. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obralake.llm import queries
from obralake.llm.decontamination import without_leaks
from obralake.llm.jaccard import keep_one_of_each
from obralake.llm.packing import pack
from obralake.llm.pseudonyms import replace_personal_data
from obralake.llm.toxicity import without_toxic
from obralake.session import store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones does not call toxic."""
    return without_toxic(docs, queries.table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of exact and near copies.

    Near copies share 80 % of their five-word shingles; op2_jaccard has a narrower rule of its own.
    """
    return keep_one_of_each(docs, 80, 5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms for personal data; the texts keep their length."""
    return replace_personal_data(docs, queries.PSEUDONYM_KEY, found_col=None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as in op8_pack."""
    return queries.pieces(pack(docs, queries.vocabulary_file()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_copies),
    ("decontamination", drop_leaks),
    ("pseudonyms", replace_private),
    ("packing", pack_sequences),
]

#: No SQL for the model, the permutations and the tokenizer; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
