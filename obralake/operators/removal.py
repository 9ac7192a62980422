"""Removing a month, and other cascades along foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cascade(tables: dict[str, DataFrame], doomed: dict[str, DataFrame],
            links: list[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """Surviving rows of each table.

    `doomed` holds the rows to remove from the root tables. `links` are (child, fk, parent, pk)
    in dependency order, parents first; a child row goes with any parent row it points to.
    """
    gone = dict(doomed)
    kept = dict(tables)
    for name, rows in doomed.items():
        pk = next(link[3] for link in links if link[2] == name)
        kept[name] = kept[name].join(rows.select(pk), pk, "left_anti")
    for child, fk, parent, pk in links:
        if parent not in gone:
            continue
        ids = gone[parent].select(F.col(pk).alias(fk)).distinct()
        lost = tables[child].join(ids, fk, "left_semi")
        gone[child] = gone[child].unionByName(lost).distinct() if child in gone else lost
        kept[child] = kept[child].join(ids, fk, "left_anti")
    return kept


STAR_LINKS = [
    ("insumos", "referencia_id", "referencias", "referencia_id"),
    ("composicoes", "referencia_id", "referencias", "referencia_id"),
    ("insumo_custos", "id", "insumos", "id"),
    ("composicao_custos", "id", "composicoes", "id"),
    ("composicao_analitico", "composicao_pai_id", "composicoes", "id"),
    ("composicao_analitico", "composicao_filha_id", "composicoes", "id"),
    ("composicao_analitico", "insumo_id", "insumos", "id"),
]


def remove_reference(tables: dict[str, DataFrame], referencia: str) -> dict[str, DataFrame]:
    """The six tables without one month."""
    doomed = tables["referencias"].filter(F.col("referencia") == referencia)
    return cascade(tables, {"referencias": doomed}, STAR_LINKS)
