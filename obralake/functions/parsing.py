"""Column expressions for cell parsing, defaults and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of a finite decimal number: no underscores, type suffixes, inf or nan.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(strip(value), F.lit(""))


def to_number(value: Column) -> Column:
    """Double, or null when the text is not a plain number."""
    return F.when(value.rlike(NUMBER), strip(value).try_cast("double"))


def half_even(value: Column, digits: int = 3) -> Column:
    """Rounded as published scores are: a tie goes to the even digit, so sums do not drift upward."""
    return F.bround(value, digits)


def to_int(value: Column, kind: str = "int") -> Column:
    """Truncating integer of a numeric text ('7.9' gives 7); null when out of range."""
    return to_number(value).try_cast(kind)


def positive_number(value: Column) -> Column:
    number = to_number(value)
    return F.when(number > 0, number)


def positive_code(value: Column) -> Column:
    code = to_int(value)
    return F.when(code > 0, code)


def has_code(code: Column) -> Column:
    return code.isNotNull() & (code != 0)


def clean_name(name: Column) -> Column:
    """Drop punctuation, turn blanks into `_`, lower-case; accented letters stay."""
    kept = F.regexp_replace(strip(name), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.lower(F.regexp_replace(kept, r"(?U)\s+", "_"))


def safe_sheet_name(name: Column) -> Column:
    """File-safe form of a sheet name; hyphens survive, each space becomes `_`."""
    kept = F.regexp_replace(name, r"(?U)[^\p{L}\p{N}_\s-]", "")
    return F.lower(F.replace(kept, F.lit(" "), F.lit("_")))


def reference_key(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))


def reference_of_name(name: Column) -> Column:
    """The YYYY-MM part of an archive name, null when absent."""
    found = F.regexp_extract(name, r"(\d{4}-\d{2})", 1)
    return F.when(found != "", found)


SEM_SHEETS = ("ISD", "CSD")


def regime_label(sheet: Column) -> Column:
    return F.when(sheet.isin(*SEM_SHEETS), "SEM DESONERACAO").otherwise("COM DESONERACAO")


def regime_code(sheet: Column) -> Column:
    return F.when(sheet.isin(*SEM_SHEETS), "SEM").otherwise("COM")


def item_type(value: Column) -> Column:
    """Row type of the bill of materials; a missing type marks the mother row."""
    kind = strip(F.upper(value))
    return F.when(kind.isNull() | (kind == "NAN"), "COMPOSICAO_MAE").otherwise(kind)


def natural_id(*parts: Column) -> Column:
    """Repeatable surrogate key of a natural key."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
