"""Constraint checks of the relational model as counts and violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compositions import CHILD_TYPES


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    return {f"nulo:{c}": F.col(c).isNull() for c in columns}


def outside(column: str, allowed: Sequence[str]) -> dict[str, Column]:
    return {f"dominio:{column}": ~F.col(column).isin(*allowed)}


def one_child(kind: str = "tipo_componente", item: str = "insumo_id",
              composition: str = "composicao_filha_id") -> dict[str, Column]:
    has_item, has_comp = F.col(item).isNotNull(), F.col(composition).isNotNull()
    fits = ((F.col(kind) == CHILD_TYPES[0]) & has_item & ~has_comp) | (
        (F.col(kind) == CHILD_TYPES[1]) & has_comp & ~has_item)
    return {"filho_unico": ~F.coalesce(fits, F.lit(False))}


def report(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All row checks of a table in one pass: one row per check with its violations."""
    names = list(checks)
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n)
                       for n, c in checks.items()])
    return counted.unpivot([], [F.col(f"`{n}`") for n in names], "regra", "violacoes")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    return child.filter(F.col(fk).isNotNull()).join(
        parent.select(F.col(pk).alias(fk)), fk, "left_anti")
