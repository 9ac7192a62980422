"""Raw sheets, held as a long cell table, turned into typed records.

A cell table has one row per non-empty cell: file, sheet, row, col, value. Row 0 is the
sheet's first line (its title line), so header lines and data are looked for from row 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..session import store

ITEM_SHEETS = ("ISD", "ICD")
COST_SHEETS = ("CSD", "CCD")
BOM_SHEET = "Analítico"
REQUIRED_SHEETS = (*ITEM_SHEETS, *COST_SHEETS, BOM_SHEET)

# Cells that give a header line away.
STATE_MARKS = ("AC", "AL", "AM")
PLACE_MARKS = ("RIO BRANCO", "MACEIO", "LOCALIDADE")
CLASS_MARKS = ("CLASSIFICAÇÃO", "CODIGO")
TITLE_WORDS = ("DESCRIÇÃO", "DESCRICAO", "GRUPO")
NOTE_WORDS = ("OBSERVAÇÃO", "OBSERVACAO")
UNIT_TITLE = "UNIDADE"

SHEET = ["file", "sheet"]
# Lines of one sheet are spread over this many join keys.
SPREAD = 16


def missing_sheets(present: DataFrame, required: Sequence[str] = REQUIRED_SHEETS) -> DataFrame:
    """Required sheets that a file lacks, one row per (file, sheet)."""
    files = present.select("file").distinct()
    wanted = files.select("file", F.explode(F.array(*map(F.lit, required))).alias("sheet"))
    return wanted.join(present.select(*SHEET).distinct(), SHEET, "left_anti")


def sheet_profile(cells: DataFrame, preview: int = 3) -> DataFrame:
    """Size of each sheet and its first lines, in one pass over the cells."""
    shown = cells.withColumn(
        "_line", F.when(F.col("row") <= preview, F.struct("row", "col", "value")))
    counted = shown.groupBy(*SHEET).agg(
        F.max("row").cast("bigint").alias("linhas"),
        (F.max("col") + 1).cast("bigint").alias("colunas"),
        F.count("*").alias("celulas"),
        F.array_sort(F.collect_list("_line")).alias("_lines"))
    return counted.select(
        *SHEET, "linhas", "colunas", "celulas",
        F.array_join(F.transform("_lines", lambda c: c["value"]), "|").alias("amostra"))


def header_rows(cells: DataFrame) -> DataFrame:
    """Last state, place and classification line of each sheet.

    Only marker cells reach the shuffle, so the pass costs a filtered scan.
    """
    mark = F.upper("value")
    marks = cells.filter(F.col("row") >= 1).select(*SHEET, "row", mark.alias("m")).filter(
        F.col("m").isin(*STATE_MARKS, *PLACE_MARKS, *CLASS_MARKS))

    def seen(word: str) -> Column:
        return F.bool_or(F.col("m") == word)

    lines = marks.groupBy(*SHEET, "row").agg(
        (seen("AC") & seen("AL") & seen("AM")).alias("state"),
        F.bool_or(F.col("m").isin(*PLACE_MARKS)).alias("place"),
        F.bool_or(F.col("m").isin(*CLASS_MARKS)).alias("title"))
    is_state = F.col("state") & ~(F.col("sheet").isin(*ITEM_SHEETS) & F.col("title"))
    return lines.groupBy(*SHEET).agg(
        F.max(F.when(is_state, F.col("row"))).alias("state_row"),
        F.max(F.when(F.col("place"), F.col("row"))).alias("place_row"),
        F.max(F.when(F.col("title"), F.col("row"))).alias("title_row"))


def first_data_row() -> Column:
    """First data line; items and compositions look at different header lines."""
    items = F.when(F.col("place_row").isNotNull(),
                   F.coalesce("title_row", "place_row") + 1)
    costs = F.when(F.col("state_row").isNotNull(),
                   F.coalesce("place_row", "state_row") + 1)
    found = F.when(F.col("sheet").isin(*ITEM_SHEETS), items).otherwise(costs)
    return F.coalesce(found, F.lit(1))


def header_column_map(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Column → (uf, place) where the state line and the place line both have a value."""
    lines = headers.filter("state_row is not null and place_row is not null").select(
        *SHEET, F.explode(F.array(
            F.struct(F.col("state_row").alias("row"), F.lit(True).alias("is_state")),
            F.struct(F.col("place_row").alias("row"), F.lit(False).alias("is_state")),
        )).alias("line")).select(*SHEET, "line.*")
    found = cells.join(lines, [*SHEET, "row"]).groupBy(*SHEET, "col").agg(
        F.max(F.when(F.col("is_state"), F.upper(P.strip(F.col("value"))))).alias("uf"),
        F.max(F.when(~F.col("is_state"), P.strip(F.col("value")))).alias("place"))
    return found.filter(F.col("uf").rlike(r"^\p{L}{2}$") & (F.col("place") != ""))


def sheet_headers(cells: DataFrame) -> DataFrame:
    """One row per sheet: first data line and column → uf map.

    Stored, so that the joins with the cells are planned on its measured size.
    """
    heads = store(header_rows(cells), "header-rows")
    columns = header_column_map(cells, heads).groupBy(*SHEET).agg(
        F.map_from_entries(F.collect_list(F.struct("col", "uf"))).alias("ufs"))
    return store(heads.select(*SHEET, first_data_row().alias("start_row")).join(
        columns, SHEET, "left"), "headers")


def latest_per_uf(values: Column) -> Column:
    """(col, uf, valor) entries → uf map; of two columns of one uf the later one counts."""
    ordered = F.array_sort(values)
    kept = F.filter(ordered, lambda v, i: ~F.exists(
        F.slice(ordered, i + 2, F.size(ordered)), lambda later: later["uf"] == v["uf"]))
    return F.map_from_entries(F.transform(kept, lambda v: F.struct(v["uf"], v["valor"])))


def sheet_lines(cells: DataFrame, headers: DataFrame, n_text: int = 5) -> DataFrame:
    """Data lines with their text columns c0.. and the uf → value map of positive numbers.

    Lines of one sheet are spread over SPREAD keys; header rows are copied to each. The same
    keys serve the join and the grouping, so cells are shuffled once at most.
    """
    spread = F.pmod(F.col("row"), F.lit(SPREAD))
    heads = headers.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    placed = cells.withColumn("part", spread).join(heads, [*SHEET, "part"], "left").filter(
        F.col("row") >= F.coalesce("start_row", F.lit(1)))
    valued = placed.select(
        *SHEET, "part", "row", "col", "value",
        F.col("ufs")[F.col("col")].alias("uf"),
        P.positive_number(F.col("value")).alias("valor"))
    entry = F.when(F.col("uf").isNotNull() & F.col("valor").isNotNull(),
                   F.struct("col", "uf", "valor"))
    texts = [F.max(F.when(F.col("col") == i, F.col("value"))).alias(f"c{i}")
             for i in range(n_text)]
    lines = valued.groupBy(*SHEET, "part", "row").agg(
        *texts, F.collect_list(entry).alias("entries"))
    return lines.withColumn("valores", latest_per_uf(F.col("entries"))).drop("entries", "part")


def cost_row_filter(descricao: Column, unidade: Column) -> Column:
    """Composition lines: real description and unit, no titles and no notes."""
    text, unit = F.upper(P.strip(descricao)), F.upper(P.strip(unidade))
    note = text.startswith(NOTE_WORDS[0]) | text.startswith(NOTE_WORDS[1])
    return (descricao.isNotNull() & unidade.isNotNull() & (text != "") & (unit != "")
            & ~text.isin(*TITLE_WORDS) & (unit != UNIT_TITLE) & ~note)


def item_row_filter(codigo: Column, descricao: Column) -> Column:
    """Item lines: a numeric code other than 0 and a description."""
    code = P.to_int(codigo)
    return code.isNotNull() & (code != 0) & (P.text_or_empty(descricao) != "")


def _origin(referencia: Column) -> list[Column]:
    return [referencia.alias("referencia"), F.col("file").alias("arquivo_origem"),
            F.col("sheet").alias("aba"), P.regime_label(F.col("sheet")).alias("tipo_desoneracao"),
            F.col("row").alias("seq")]


def item_records(lines: DataFrame, referencia: Column) -> DataFrame:
    kept = lines.filter(F.col("sheet").isin(*ITEM_SHEETS)).filter(
        item_row_filter(F.col("c1"), F.col("c2")))
    return kept.select(
        P.to_int(F.col("c1")).alias("codigo"), P.text_or_empty(F.col("c0")).alias("categoria"),
        P.strip(F.col("c2")).alias("descricao"), P.text_or_empty(F.col("c3")).alias("unidade"),
        P.text_or_empty(F.col("c4")).alias("origem_preco"), F.col("valores").alias("precos"),
        *_origin(referencia))


def cost_records(lines: DataFrame, referencia: Column) -> DataFrame:
    kept = lines.filter(F.col("sheet").isin(*COST_SHEETS)).filter(
        cost_row_filter(F.col("c2"), F.col("c3")))
    return kept.select(
        P.positive_code(F.col("c1")).alias("codigo"), P.text_or_empty(F.col("c0")).alias("categoria"),
        P.strip(F.col("c2")).alias("descricao"), P.strip(F.col("c3")).alias("unidade"),
        F.col("valores").alias("custos"), *_origin(referencia))


def bom_rows(cells: DataFrame, referencia: Column) -> DataFrame:
    """Flat bill of materials: lines of the analytic sheet whose mother code is numeric."""
    texts = [F.max(F.when(F.col("col") == i, F.col("value"))).alias(f"c{i}") for i in range(8)]
    lines = cells.filter((F.col("sheet") == BOM_SHEET) & (F.col("row") >= 1)).groupBy(
        *SHEET, "row").agg(*texts)
    return lines.filter(P.to_number(F.col("c1")).isNotNull()).select(
        F.col("c0").alias("categoria"), P.to_int(F.col("c1")).alias("codigo_composicao_mae"),
        P.item_type(F.col("c2")).alias("tipo_item"),
        P.to_int(F.col("c3"), "bigint").alias("codigo_item_filho"),
        F.col("c4").alias("descricao"), F.col("c5").alias("unidade"),
        P.to_number(F.col("c6")).alias("coeficiente"), F.col("c7").alias("situacao"),
        referencia.alias("referencia"), F.col("file").alias("arquivo_origem"),
        F.col("sheet").alias("aba"), F.col("row").alias("seq"))


def generic_rows(cells: DataFrame, sheet: str, names: dict[int, str], referencia: Column) -> DataFrame:
    """Any other sheet, with its known title line: cleaned names, non-empty lines, origin columns.

    Empty lines and columns own no cells, so they are absent already.
    """
    picked = [F.max(F.when(F.col("col") == i, F.col("value"))).alias(name)
              for i, name in names.items()]
    lines = cells.filter((F.col("sheet") == sheet) & (F.col("row") >= 1)).groupBy(
        *SHEET, "row").agg(*picked)
    return lines.select(
        *names.values(), referencia.alias("referencia"),
        F.col("file").alias("arquivo_origem"), F.col("sheet").alias("aba"),
        F.col("row").alias("seq"))


def title_names(cells: DataFrame, sheet: str) -> DataFrame:
    """Cleaned column names of a sheet's title line; unnamed columns that hold data are numbered."""
    own = cells.filter(F.col("sheet") == sheet)
    used = own.groupBy(*SHEET, "col").agg(
        F.max(F.when(F.col("row") == 0, F.col("value"))).alias("title"),
        F.max(F.col("row")).alias("last"))
    raw = F.coalesce("title", F.concat(F.lit("Unnamed: "), F.col("col").cast("string")))
    return used.filter(F.col("last") >= 1).select(*SHEET, "col", P.clean_name(raw).alias("name"))


def wide_to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 name: str = "uf", value: str = "valor") -> DataFrame:
    """Value columns → rows, keeping positive numbers only."""
    kept = df.select(*keys, *columns).unpivot(list(keys), list(columns), name, value)
    return kept.filter((F.col(value) > 0) & ~F.isnan(value))


def map_to_long(df: DataFrame, keys: Sequence[str], mapping: str,
                name: str = "uf", value: str = "valor") -> DataFrame:
    return df.select(*keys, F.explode(mapping).alias(name, value)).filter(F.col(value).isNotNull())


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(columns) if columns else None)


def filled_columns(df: DataFrame) -> DataFrame:
    """Non-null count of every column, one row per column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "coluna", "preenchidas")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Wide data without its all-null columns; one aggregate row decides."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c]])
