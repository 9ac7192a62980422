"""Hand-written cell tables: header search, row filters, code recovery, tree."""

from datetime import datetime

from pyspark.sql import functions as F

from obralake.operators import compositions as C
from obralake.operators import sheets as S
from obralake.operators import star

SCHEMA = "file string, sheet string, row bigint, col int, value string"
MONTH = "2025-12"


def cells(spark, sheet, grid):
    """Grid of lines; the first line is the title line (row 0)."""
    rows = [("f", sheet, r, c, str(v)) for r, line in enumerate(grid)
            for c, v in enumerate(line) if v is not None]
    return spark.createDataFrame(rows, SCHEMA)


def lines(table):
    return S.sheet_lines(table, S.sheet_headers(table))


ISD = [
    ["Título"],
    [None, None, None, None, None, "AC", "AL", "AM"],
    [None, None, None, None, "LOCALIDADE", "RIO BRANCO", "MACEIO", "MANAUS"],
    ["CLASSIFICAÇÃO", "CODIGO", "DESCRIÇÃO", "UNIDADE", "ORIGEM"],
    ["MAT", "10", " CIMENTO ", "KG", "C", "1.5", "0", "2.25"],
    ["MAT", "11.0", "AREIA", None, "C", "1.234,56", "3", None],
    ["MAT", "0", "NADA", "KG", "C", "1", "1", "1"],
    ["MAT", "x", "TEXTO", "KG", "C", "1", "1", "1"],
    ["MAT", "-4", "NEGATIVO", "KG", None, "1", None, None],
]


def items(spark, grid):
    rows = S.item_records(lines(cells(spark, "ISD", grid)), F.lit(MONTH)).collect()
    return {r["codigo"]: r for r in rows}


def test_item_records(spark):
    got = items(spark, ISD)
    assert set(got) == {10, 11, -4}
    assert got[10]["precos"] == {"AC": 1.5, "AM": 2.25}
    assert got[10]["descricao"] == "CIMENTO"
    assert got[11]["precos"] == {"AL": 3.0}
    assert got[11]["unidade"] == ""
    assert got[-4]["origem_preco"] == ""
    assert got[10]["tipo_desoneracao"] == "SEM DESONERACAO"


def test_empty_rows_above_the_header_change_nothing(spark):
    shifted = [ISD[0], [], [], *ISD[1:]]
    strip = lambda got: {k: (r["precos"], r["descricao"], r["unidade"]) for k, r in got.items()}
    assert strip(items(spark, shifted)) == strip(items(spark, ISD))


CSD = [
    ["Título"],
    [None, None, None, None, "AC", "AC", "AC", "AL", "AM"],
    [None, None, None, None, "RIO BRANCO", None, "OUTRA", "MACEIO", "MANAUS"],
    ["SERV", None, "ALVENARIA", "M2", "10", "99", "12", "7", None],
    ["SERV", "55", "REBOCO", "M2", "10", "99", "0", "7", None],
    ["SERV", "1", "OBSERVAÇÃO: nada", "M2", "1"],
    ["SERV", "2", "Descrição", "M2", "1"],
    ["SERV", "3", "LAJE", "Unidade", "1"],
    ["SERV", "4", "LAJE", " ", "1"],
]


def test_cost_records(spark):
    rows = S.cost_records(lines(cells(spark, "CSD", CSD)), F.lit(MONTH)).collect()
    got = {r["descricao"]: r for r in rows}
    assert set(got) == {"ALVENARIA", "REBOCO"}
    # The column without a place is ignored; of two columns of a state the later positive one counts.
    assert got["ALVENARIA"]["custos"] == {"AC": 12.0, "AL": 7.0}
    assert got["REBOCO"]["custos"] == {"AC": 10.0, "AL": 7.0}
    assert got["ALVENARIA"]["codigo"] is None and got["REBOCO"]["codigo"] == 55


def test_start_rows(spark):
    state, place, title = ISD[1], ISD[2], ISD[3]
    def start(sheet, grid):
        heads = S.header_rows(cells(spark, sheet, grid)).withColumn("s", S.first_data_row())
        got = heads.collect()
        return got[0]["s"] if got else 1
    assert start("ISD", [["t"], state, place, title]) == 4
    assert start("ISD", [["t"], state, place]) == 3
    assert start("ISD", [["t"], state, ["x"], title]) == 1
    assert start("CSD", [["t"], state, place, title]) == 3
    assert start("CSD", [["t"], state]) == 2
    assert start("CSD", [["t"], place]) == 1
    assert start("CSD", [["t"], ["x"]]) == 1


BOM = [
    ["Título"],
    [None, "CODIGO", "TIPO", "ITEM", "DESCRIÇÃO", "UN", "COEF", "SIT"],
    ["SERV", "100", None, None, "PAREDE", "M2", None, "OK"],
    ["SERV", "100", " insumo ", "7", "TIJOLO", "UN", "25", "OK"],
    ["SERV", "100", "COMPOSICAO", "200", "MASSA", "M3", "ruim", None],
    ["SERV", "300", "INSUMO", "7", "TIJOLO", "UN", "1", "OK"],
    ["SERV", "400", "nan", None, "VAZIA", "M2", None, None],
]


def test_bom_and_tree(spark):
    bom = S.bom_rows(cells(spark, "Analítico", BOM), F.lit(MONTH))
    assert bom.count() == 5
    tree = {r["codigo"]: r for r in C.nest(bom).collect()}
    assert set(tree) == {100, 400}
    children = tree[100]["componentes"]
    assert [(c["tipo"], c["codigo"], c["coeficiente"]) for c in children] == [
        ("INSUMO", 7, 25.0), ("COMPOSICAO", 200, None)]
    assert tree[400]["componentes"] == [] and tree[400]["unidade"] == "M2"


def test_edges_need_no_tree(spark):
    """The last line of a child counts, whatever the number of lines."""
    grid = [["t"], ["S", "1", None, None, "MAE", "M2"]] + [
        ["S", "1", "INSUMO", str(i % 5), "F", "UN", str(i)] for i in range(5, 25)]
    bom = S.bom_rows(cells(spark, "Analítico", grid), F.lit(MONTH))
    tree = C.nest(bom).collect()
    assert len(tree) == 1 and len(tree[0]["componentes"]) == 20
    lines = star.bom_lines(bom).collect()
    assert {r["unidade_pai"] for r in lines} == {"M2"}
    ids = spark.createDataFrame([(MONTH, i, "UN", f"i{i}") for i in range(5)],
                                "referencia string, codigo int, unidade string, id string")
    comp = spark.createDataFrame([(MONTH, 1, "M2", "c")], ids.schema)
    got = {r["insumo_id"]: r["coeficiente"] for r in star.edges(star.bom_lines(bom), ids, comp).collect()}
    assert got == {f"i{i}": 20.0 + i for i in range(1, 5)}


def test_code_recovery(spark):
    bom = spark.createDataFrame(
        [("m", 1, C.MOTHER, "Parede", "m2", 10), ("m", 2, C.MOTHER, "PAREDE", "M3", 20),
         ("m", 3, C.MOTHER, "PISO", "M2", 30), ("m", 4, C.MOTHER, "PISO", "M2", 31),
         ("m", 5, "INSUMO", "TIJOLO", "UN", 40)],
        "referencia string, seq int, tipo_item string, descricao string, unidade string, codigo_composicao_mae int")
    costs = spark.createDataFrame(
        [("m", 1, None, " parede ", "M2"), ("m", 2, None, "Parede", "M3"), ("m", 3, None, "parede", "KG"),
         ("m", 4, None, "piso", "m2"), ("m", 5, None, "TIJOLO", "UN"), ("m", 6, 77, "PISO", "M2")],
        "referencia string, seq int, codigo int, descricao string, unidade string")
    got = {r["seq"]: r["codigo"] for r in C.recover_codes(costs, bom).collect()}
    assert got == {1: 10, 2: 20, 3: 20, 4: 31, 5: None, 6: 77}


def test_generic_sheet_and_title_names(spark):
    table = cells(spark, "Outra", [["Código (novo)", "Índice %", None], ["1", None, "z"], [None, "2", None]])
    names = {r["col"]: r["name"] for r in S.title_names(table, "Outra").collect()}
    assert names == {0: "código_novo", 1: "índice_", 2: "unnamed_2"}
    rows = S.generic_rows(table, "Outra", names, F.lit(MONTH)).orderBy("seq").collect()
    assert [(r["código_novo"], r["índice_"], r["unnamed_2"]) for r in rows] == [("1", None, "z"), (None, "2", None)]


def test_sales_are_joined_once_for_all_sheets(spark):
    from suite import common

    cells = common.price_cells(spark, "/root/testdata/sf0.001")
    assert "l_orderkey" not in cells._jdf.queryExecution().executedPlan().toString()
    for sheets in (S.ITEM_SHEETS, S.COST_SHEETS, [S.BOM_SHEET]):
        some = common.price_cells(spark, "/root/testdata/sf0.001", sheets)
        same = cells.filter(F.col("sheet").isin(*sheets))
        assert some.exceptAll(same).isEmpty() and same.exceptAll(some).isEmpty()


def test_long_rows_are_summed_where_their_key_lies(spark):
    import __spark_entry__ as entry

    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_partkey" in plan and "REPARTITION" in plan


def small_tables(spark, folder):
    """A nation, customer, supplier and part, and an order of two months with a line each."""
    rows = {
        "nation": ("n_nationkey bigint, n_name string", [(0, "NATION_0"), (1, "NATION_1")]),
        "customer": ("c_custkey bigint, c_nationkey bigint", [(1, 1)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double", [(3, "Supplier", 7, 5000.0)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string", [(2, "red gear", "Brand#1", "SMALL")]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz", [
            (1, 1, datetime(1997, 3, 1)), (2, 1, datetime(1997, 4, 1))]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
                      "l_linestatus string, l_returnflag string", [(1, 2, 3, 4.0, 9.5, "F", "R"), (2, 2, 3, 1.0, 2.5, "O", "N")])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_profile_gives_the_first_lines_of_each_sheet(spark, tmp_path):
    from suite import sheets

    got = {(r["file"], r["sheet"]): r for r in sheets.sheet_profile(spark, small_tables(spark, tmp_path)).collect()}
    assert {k[1] for k in got if k[0] == "1997-03.xlsx"} == {"ISD", "CSD", S.BOM_SHEET}
    assert got["1997-03.xlsx", "ISD"]["linhas"] == 12
    # The title line and the states; the analytic sheet has its first line further down.
    assert got["1997-03.xlsx", "ISD"]["amostra"] == "Tabela de Preços e Custos|AC|AL"
    assert got["1997-04.xlsx", "CCD"]["amostra"] == "Tabela de Preços e Custos|AC|AL"
    assert got["1997-03.xlsx", S.BOM_SHEET]["amostra"] == ""
