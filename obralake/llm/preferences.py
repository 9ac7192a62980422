"""Preference pairs as one prompt and two masked completions (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before and after the text of a turn; the role stands inside the first.
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
#: The role whose turns are trained on.
TRAINED = "assistant"


def _head(turn: Column) -> Column:
    before, after = OPEN.split("{}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(
        turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _trained(turns: Column) -> Column:
    """Code points of the rendered turns that are trained on: text and close of TRAINED turns."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def add(s: Column, t: Column) -> Column:
        start = s["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + len(CLOSE)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(
            t["role"] == TRAINED, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, state, add)["spans"]


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", chosen_col: str = "chosen",
                       turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """One row per pair: `n_prompt`, `prompt`, `chosen`, `rejected`, `chosen_spans`, `rejected_spans`.

    `turns` holds both conversations of each pair, told apart by the boolean `chosen_col`. Turns that
    both begin with, equal in role and text, are rendered once as the prompt; the rest of each is its
    completion, with the code points to train on; all else, the prompt included, is masked.

    Turns go by `turn_col`, then role and text; repeated turns are kept. A null role or text is empty;
    rows without a pair or side belong to no conversation. If a side is missing or the conversations
    are equal, completions may be empty. An empty table gives no rows; other columns are not read. A
    conversation is one row of the result, so it is also what one task holds.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                    F.coalesce(text_col, F.lit("")).alias("text"))
    side = lambda wanted: F.sort_array(F.collect_list(
        F.when(F.col(chosen_col) == F.lit(wanted), turn)))
    both = turns.filter(F.col(pair_col).isNotNull() & F.col(chosen_col).isNotNull()).groupBy(
        pair_col).agg(side(True).alias("c"), side(False).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: F.struct(a["role"], a["text"]).eqNullSafe(
        F.struct(b["role"], b["text"])))
    differs = F.array_position(same, False)
    both = both.withColumn("n", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side), F.lit(1)))
    return both.select(
        pair_col, F.col("n").alias("n_prompt"), _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _render(rest("c")).alias("chosen"), _render(rest("r")).alias("rejected"),
        _trained(rest("c")).alias("chosen_spans"), _trained(rest("r")).alias("rejected_spans"))
