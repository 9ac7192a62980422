"""A month from archive to relational tables, repeats, removal and arrivals."""

import os
import warnings
import zipfile
import zlib
from io import BytesIO as io_bytes

from pyspark.sql import functions as F

from obralake.operators import picks
from obralake.operators import removal
from obralake.operators import star
from obralake.plans import etl
from obralake.session import checkpoint_root, drop_stored, scratch_path, store
from obralake.sources import tables as io
from obralake.sources import workbooks as W
from obralake.streaming.arrivals import archive_stream, load_archives
from suite import books
from suite.books import pack_archive, pack_workbook

from .test_sheets import BOM, CSD, ISD, cells, small_tables


def grid(rows):
    return [[None if v is None else v for v in line] for line in rows]


def archive(tmp_path, month="2025-12", price="1.5"):
    isd = [*ISD[:4], ["MAT", "7", "TIJOLO", "UN", "C", price, "2", "3"],
           ["MAT", "7", "TIJOLO REPETIDO", "UN", "C", "9", None, None]]
    icd = [*ISD[:4], ["MAT", "7", "OUTRO NOME", "UN", "C", "4", None, "N/A"]]
    csd = [*CSD[:3], ["SERV", None, "PAREDE", "M2", "10", "99", None, "7", None]]
    book = pack_workbook({"ISD": grid(isd), "ICD": grid(icd), "CSD": grid(csd), "CCD": grid(csd),
                          "Analítico": grid(BOM), "Capa": [["x"]]})
    content = pack_archive({"Referência.xlsx": book, "Familias.xlsx": pack_workbook({"ISD": [["y"]]})})
    path = tmp_path / f"TABELA-{month}-formato-xlsx.zip"
    path.write_bytes(content)
    return path


def test_month_end_to_end(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    archive(source)
    (source / "TABELA-2025-11-formato-xlsx.zip").write_bytes(b"PK broken")
    valid = {os.path.basename(r["path"]): r["valido"] for r in W.integrity(
        W.read_files(spark, str(source))).collect()}
    assert valid == {"TABELA-2025-12-formato-xlsx.zip": True, "TABELA-2025-11-formato-xlsx.zip": False}
    target = scratch_path(spark, "target")
    for _ in range(2):
        got, archives, formats = etl.run(spark, str(source), target, ("json", "csv", "parquet"))
    assert {os.path.basename(r["path"])[7:14]: r["outcome"][:4] for r in archives.collect()} == {
        "2025-12": "used", "2025-11": "BadZ"}
    assert all(o == "ok" for by in formats.values() for o in by.values())
    assert spark.read.json(f"{target}/metadata").filter("referencia = '2025-12'").count() == 5
    read = lambda t: spark.read.parquet(f"{target}/relational/{t}")
    items = read("insumos").collect()
    assert [(r["codigo"], r["descricao"], r["unidade"]) for r in items] == [(7, "TIJOLO", "UN")]
    costs = {(r["uf"], r["tipo_desoneracao"]): r["custo"] for r in read("insumo_custos").collect()}
    # Of repeated items the last price of a state counts.
    assert costs == {("AC", "SEM"): 9.0, ("AL", "SEM"): 2.0, ("AM", "SEM"): 3.0, ("AC", "COM"): 4.0}
    comps = read("composicoes").collect()
    assert [(r["codigo"], r["descricao"]) for r in comps] == [(100, "PAREDE")]
    edges = read("composicao_analitico").collect()
    assert [(e["tipo_componente"], e["insumo_id"], e["coeficiente"]) for e in edges] == [
        ("INSUMO", items[0]["id"], 25.0)]
    assert read("referencias").select("referencia").collect()[0][0] == "2025-12"
    tree = spark.read.json(f"{target}/processed/analítico/json").collect()
    assert {r["codigo"] for r in tree} == {100, 400}
    left = removal.remove_reference({t: df for t, df in got.items()}, "2025-12")
    assert all(df.count() == 0 for df in left.values())
    assert io.drop_reference(spark, f"{target}/relational/insumos", "2025-12")
    assert not io.drop_reference(spark, f"{target}/relational/insumos", "2025-12")


def test_archives_are_not_mixed(spark, tmp_path):
    """Two archives of a month, one without a month, one with a broken sheet; parsed in one pass."""
    old = archive(tmp_path, "2025-12", "9")
    old.rename(tmp_path / "TABELA-2025-12-antes.zip")
    os.utime(tmp_path / "TABELA-2025-12-antes.zip", (1, 1))
    archive(tmp_path, "2025-12", "1.5")
    os.utime(tmp_path / "TABELA-2025-12-formato-xlsx.zip", (2, 2))
    archive(tmp_path, "2025-11", "3").rename(tmp_path / "TABELA-sem-mes.zip")
    broken = pack_workbook({"ISD": grid(ISD), "CSD": grid(CSD)})
    book = zipfile.ZipFile(io_bytes(broken))
    parts = {n: book.read(n) for n in book.namelist()} | {"xl/worksheets/sheet1.xml": b"<worksheet><c r="}
    out = io_bytes()
    with zipfile.ZipFile(out, "w") as z:
        for name, part in parts.items():
            z.writestr(name, part)
    (tmp_path / "TABELA-2025-10.zip").write_bytes(pack_archive({"Referência.xlsx": out.getvalue()}))
    cells, report = etl.read_cells(spark, str(tmp_path))
    seen = {(os.path.basename(r["path"]), r["sheet"]): r["outcome"].split(":")[0] for r in report.collect()}
    assert seen == {("TABELA-2025-12-antes.zip", None): "superseded", ("TABELA-2025-12-formato-xlsx.zip", None): "used",
                    ("TABELA-sem-mes.zip", None): "no month", ("TABELA-2025-10.zip", None): "used",
                    ("TABELA-2025-10.zip", "ISD"): "ParseError"}
    assert {r[0] for r in cells.select("referencia").distinct().collect()} == {"2025-12", "2025-10"}
    assert {r[0] for r in cells.filter("referencia = '2025-10'").select("sheet").distinct().collect()} == {"CSD"}
    latest, _ = etl.read_cells(spark, str(tmp_path), "latest")
    assert {r[0] for r in latest.select("referencia").distinct().collect()} == {"2025-12"}
    got = etl.run(spark, str(tmp_path), scratch_path(spark, "target"), ("json",), month="2025-12")
    prices = {r["custo"] for r in got.tables["insumo_custos"].filter("uf = 'AL'").collect()}
    assert prices == {2.0}
    plan = W.parse(W.read_files(spark, str(tmp_path)))._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("MapInPandas") == 1


def test_reload_keeps_first_names_and_clears_months(spark, tmp_path):
    source, target = tmp_path / "in", scratch_path(spark, "target")
    source.mkdir()
    archive(source)
    etl.run(spark, str(source), target, ("json",))
    first = spark.read.parquet(f"{target}/relational/insumos").first()["descricao"]
    isd = [*ISD[:4], ["MAT", "7", "NOVO NOME", "UN", "C", "5", None, None]]
    book = pack_workbook({"ISD": grid(isd), "ICD": grid(ISD[:4]), "CSD": grid(CSD[:3]), "CCD": grid(CSD[:3]),
                          "Analítico": [["t"]]})
    (source / "TABELA-2025-12-formato-xlsx.zip").write_bytes(pack_archive({"Referência.xlsx": book}))
    got = etl.run(spark, str(source), target, ("json",))
    assert [r["descricao"] for r in got.tables["insumos"].collect()] == [first]
    costs = {(r["uf"], r["tipo_desoneracao"]): r["custo"] for r in got.tables["insumo_custos"].collect()}
    assert costs == {("AC", "SEM"): 5.0, ("AL", "SEM"): 2.0, ("AM", "SEM"): 3.0, ("AC", "COM"): 4.0}
    assert got.tables["composicao_analitico"].count() == 0
    assert spark.read.parquet(f"{target}/relational/composicoes").count() == 1
    assert not io.has_months(spark, f"{target}/processed/icd/json")
    assert not io.has_months(spark, f"{target}/relational/composicao_analitico")


def test_archives_arrive_in_any_order(spark, tmp_path):
    """One archive a batch: the later one replaces the month, one that comes late or again changes nothing."""
    source, target = tmp_path / "in", scratch_path(spark, "target")
    source.mkdir()

    def put(name, at, content=None):
        path = archive(tmp_path) if content is None else tmp_path / "made.zip"
        if content is not None:
            path.write_bytes(content)
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))
        path.rename(source / name)

    def state():
        read = lambda t: spark.read.parquet(f"{target}/relational/{t}").collect()
        return ([(r["referencia"], r["codigo"], r["descricao"]) for r in read("insumos")],
                sorted((r["uf"], r["tipo_desoneracao"], r["custo"]) for r in read("insumo_custos")),
                io.has_months(spark, f"{target}/relational/composicao_analitico"))

    def outcomes():
        return sorted((r["path"].rsplit("/", 1)[-1], r["outcome"][:10]) for r in spark.read.parquet(
            f"{target}/outcomes").collect())

    marks = scratch_path(spark, "marks")
    run = lambda at=marks: load_archives(archive_stream(spark, str(source), files_per_batch=1), target, at)
    isd = [*ISD[:4], ["MAT", "7", "NOVO NOME", "UN", "C", "5", None, None]]
    put("A-2025-12.zip", 100)
    put("B-2025-11.zip", 150, b"PK broken")
    run()
    assert state()[0] == [("2025-12", 7, "TIJOLO")] and state()[2]
    put("C-2025-12.zip", 300, pack_archive({"Referência.xlsx": pack_workbook({"ISD": grid(isd)})}))
    put("D-2025-12.zip", 200)
    run()
    want = ([("2025-12", 7, "NOVO NOME")], [("AC", "SEM", 5.0)], False)
    assert state() == want
    put("E-2025-12.zip", 250)
    run()
    assert state() == want
    assert outcomes() == [("A-2025-12.zip", "used"), ("B-2025-11.zip", "BadZipFile"), ("C-2025-12.zip", "used"),
                          ("D-2025-12.zip", "used"), ("E-2025-12.zip", "superseded")]
    run(scratch_path(spark, "marks"))  # all again, from the first
    assert state() == want
    assert ("A-2025-12.zip", "superseded") in outcomes()


def test_repeated_keys_of_one_batch_store_one_row(spark):
    rows = spark.createDataFrame([(1, 5.0, "b", "m"), (1, 5.0, "a", "m"), (1, 2.0, "z", "m")],
                                 "id int, v double, t string, referencia string")
    got = picks.upsert(rows.limit(0), rows, ["id"], ["v"]).collect()
    assert [(r["v"], r["t"]) for r in got] == [(5.0, "b")]


def test_upsert_touches_only_its_months(spark):
    path = scratch_path(spark, "facts")
    rows = lambda v: spark.createDataFrame(v, "id int, custo double, referencia string")
    io.write_table(rows([(1, 1.0, "a"), (2, 2.0, "a"), (1, 5.0, "b")]), path)
    io.upsert_table(rows([(2, 20.0, "a"), (3, 30.0, "a")]), path, ["referencia", "id"], ["custo"])
    got = {(r["referencia"], r["id"]): r["custo"] for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 20.0, ("a", 3): 30.0, ("b", 1): 5.0}
    assert [r[0] for r in io.list_references(spark, path).collect()] == ["a", "b"]


def test_edges_keep_the_last_coefficient(spark):
    ent = lambda kind, rows: spark.createDataFrame(rows, "referencia string, codigo int, unidade string").withColumn(
        "id", star.entity_id(kind))
    items, comps = ent("insumo", [("m", 7, "UN")]), ent("composicao", [("m", 1, "M2"), ("m", 2, "M2")])
    lines = spark.createDataFrame(
        [("m", 1, "M2", "insumo ", 7, " UN ", 1.0, 1), ("m", 1, "M2", "INSUMO", 7, "UN", 2.0, 2),
         ("m", 1, "M2", "COMPOSICAO", 2, "M2", None, 3), ("m", 1, "M2", "COMPOSICAO", 9, "M2", 1.0, 4),
         ("m", 5, "M2", "INSUMO", 7, "UN", 1.0, 5), ("m", 1, "M2", "SERVICO", 7, "UN", 1.0, 6),
         ("m", 1, "M2", "INSUMO", 7, "", 1.0, 7), ("m", 1, "M2", "INSUMO", 0, "UN", 1.0, 8)],
        "referencia string, codigo_pai int, unidade_pai string, tipo string, codigo_filho int, "
        "unidade string, coeficiente double, seq int")
    got = sorted((e["tipo_componente"], e["coeficiente"]) for e in star.edges(lines, items, comps).collect())
    assert got == [("COMPOSICAO", 0.0), ("INSUMO", 2.0)]


def test_text_sources(spark, tmp_path):
    prices = tmp_path / "p.csv"
    prices.write_text('codigo,descricao,unidade,preco_mediano,mes_referencia,desonerado\n'
                      '007,"CAIXA 4"" X 2""",UN,1.5,2025-12,False\n', encoding="utf-8")
    r = io.read_prices(spark, str(prices)).first()
    assert (r["codigo"], r["descricao"], r["preco_mediano"], r["desonerado"]) == ("007", 'CAIXA 4" X 2"', 1.5, "False")
    skus = tmp_path / "s.csv"
    skus.write_text("﻿SKU (REF);Produto;Marca\n12;Cabo;\n", encoding="utf-8")
    r = io.read_catalogue(spark, str(skus), ["SKU (REF)", "Produto", "Marca"]).first()
    assert (r["SKU (REF)"], r["Produto"], r["Marca"]) == ("12", "Cabo", "")
    docs = tmp_path / "isd.json"
    docs.write_text('[{"codigo": 1, "descricao": "A", "precos": {"AC": 1.0}}]', encoding="utf-8")
    r = io.read_documents(spark, str(docs), io.ITEM_SCHEMA).first()
    assert r["codigo"] == 1 and r["precos"] == {"AC": 1.0}


def test_latest_reference(spark):
    rows = [("2025-12", False), ("2025-10", True), ("2025-11", True), ("2024-12", True), ("2026-01", True)]
    manifest = spark.createDataFrame(rows, "referencia string, valido boolean")
    assert io.latest_reference(manifest, "2025-12-15").first()[0] == "2025-11"
    old = manifest.filter("referencia = '2024-12'")
    assert io.latest_reference(old, "2025-12-15").first()[0] is None
    assert io.pending(manifest, old).count() == 4


def test_members_of_one_name_in_two_folders(spark, tmp_path):
    book = lambda text: pack_workbook({"ISD": [[text]], "Capa": [["c"]]})
    out = io_bytes()
    with zipfile.ZipFile(out, "w") as z, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, content in (("a/X.xlsx", book("um")), ("b/X.xlsx", book("dois")), ("c/", b""), ("b/X.xlsx", book("três")),
                              ("d/Y.xlsx", b"no workbook"), ("leia.txt", b"x"), ("a/Referência.xlsx", book("main"))):
            z.writestr(name, content)
    (tmp_path / "A-2025-12.zip").write_bytes(out.getvalue())
    (tmp_path / "B-2025-12.zip").write_bytes(b"PK broken")
    (tmp_path / "C.xlsx").write_bytes(book("só"))
    files = W.read_files(spark, str(tmp_path))
    name = lambda p: os.path.basename(p)
    listed = sorted((name(r.path), r.member or "", (r.problem or "").split(":")[0]) for r in W.members(files).collect())
    assert listed == [("A-2025-12.zip", "a/Referência.xlsx", ""), ("A-2025-12.zip", "a/X.xlsx", ""),
                      ("A-2025-12.zip", "b/X.xlsx", ""), ("A-2025-12.zip", "b/X.xlsx", "repeated name"),
                      ("A-2025-12.zip", "d/Y.xlsx", ""), ("A-2025-12.zip", "leia.txt", ""),
                      ("B-2025-12.zip", "", "BadZipFile"), ("C.xlsx", "C.xlsx", "")]
    first = next(r for r in W.members(files).collect() if r.member == "leia.txt")
    assert (first.bytes, first.crc32) == (1, zlib.crc32(b"x"))
    want = {("A-2025-12.zip", "a/X.xlsx", "um"), ("A-2025-12.zip", "b/X.xlsx", "três"), ("C.xlsx", "C.xlsx", "só"),
            ("A-2025-12.zip", "a/Referência.xlsx", "main")}
    for parsed in (W.parse(files, ["ISD"]), W.member_cells(W.unpack(files), ["ISD"])):
        rows = parsed.collect()
        cells = {(name(r.path), r.file, r.value) for r in rows if r.problem is None}
        problems = {(name(r.path), r.file, r.problem.split(":")[0]) for r in rows if r.problem}
        assert ("A-2025-12.zip", "b/X.xlsx", "repeated name") in problems
        assert ("B-2025-12.zip", None, "BadZipFile") in problems
        assert any("d/Y.xlsx" in (f or "") and p == "BadZipFile" for _, f, p in problems)
        assert cells == want  # a broken member does not stop the ones after it
    main = W.cells(files, ["ISD"], main_only=True).collect()
    assert [(r.file, r.value) for r in main] == [("a/Referência.xlsx", "main")]


def test_records_of_the_star_are_read_from_the_store(spark, tmp_path):
    """Six tables are made of them: the sales are joined once and not once per table."""
    from suite import star as suite_star
    rows = {
        "customer": "SELECT 1L c_custkey, 3 c_nationkey",
        "orders": "SELECT 5L o_orderkey, 1L o_custkey, timestamp'1997-03-02' o_orderdate",
        "part": "SELECT 7L p_partkey, 4 p_size, 'PROMO' p_type, 'cabo' p_name, 'M' p_brand",
        "lineitem": "SELECT 5L l_orderkey, 7L l_partkey, explode(array('F', 'O')) l_linestatus, 2.5D l_extendedprice"}
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    sem, com = suite_star._records(spark, str(tmp_path), stored=True)
    plan = sem.unionByName(com)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert [(r.referencia, r.codigo, list(r.precos.values())) for r in sem.collect()] == [("1997-03", 4, [2.5])]
    assert com.count() == 1


def test_many_small_months_are_written_by_several_tasks(spark, tmp_path):
    months = [f"{1000 + i // 12}-{i % 12 + 1:02d}" for i in range(100)]
    rows = spark.createDataFrame([(m, i) for m in months for i in range(3)], "referencia string, id int")
    etl.write_relational({name: rows for name in etl.TABLES}, str(tmp_path), months)
    for name in etl.TABLES:
        files = list((tmp_path / name).glob("referencia=*/part-*.parquet"))
        assert len(files) == 100 and len({f.name.split("-")[1] for f in files}) > 4
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / name)).select("referencia", "id").collect())) == sorted(
            (m, i) for m in months for i in range(3))


def test_only_stored_months_are_cleared(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "referencia string, id int")
    io.write_table(rows, str(tmp_path / "t"))
    asked, real = [], io.drop_reference
    monkeypatch.setattr(io, "drop_reference", lambda s, path, month: asked.append(month) or real(s, path, month))
    io.clear_months(rows.filter("id = 2"), str(tmp_path / "t"), ["2024-01", "2024-02", "2025-01", "2025-02"])
    io.clear_months(rows.limit(0), str(tmp_path / "none"), ["2024-01"])
    assert asked == ["2024-01"]
    assert [p.name for p in (tmp_path / "t").glob("referencia=*")] == ["referencia=2024-02"]


def test_only_stored_tables_are_dropped(spark, tmp_path):
    """What a table is read from goes if it was stored; files elsewhere stay."""
    spark.range(5).write.parquet(f"{tmp_path}/given")
    kept = store(spark.range(7), "kept")
    made = store(spark.range(3), "made").join(spark.read.parquet(f"{tmp_path}/given"), "id")
    folders = {f.rsplit("/", 1)[0].removeprefix("file:").replace("///", "/") for f in made.inputFiles()}
    drop_stored(made)
    assert sorted(os.path.exists(f) for f in folders) == [False, True]
    assert kept.count() == 7 and spark.read.parquet(f"{tmp_path}/given").count() == 5


def test_cells_of_the_months_go_once_their_sheets_are_stored(spark, tmp_path):
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    tables = books._stored_months(spark, small_tables(spark, tmp_path))
    left = [f.rsplit("-", 1)[0] for f in set(os.listdir(root)) - before]
    assert left.count("sheet") == 5 and not {"sales", "amounts", "cells", "lines"} & set(left)
    assert tables["ISD"].count() == 1 and os.path.exists(f"{tmp_path}/part.parquet")


def test_entities_are_made_once_for_their_table_and_for_edges(spark):
    sheets = [cells(spark, s, g) for s, g in (("ISD", ISD), ("ICD", ISD), ("CSD", CSD), ("CCD", CSD), ("Analítico", BOM))]
    every = sheets[0]
    for more in sheets[1:]:
        every = every.unionByName(more)
    tables = etl.process(every, F.lit("2025-12"))
    plain, staged = etl.relational(tables), etl.relational(tables, staged=True)
    for name in etl.TABLES:
        assert sorted(map(str, plain[name].collect())) == sorted(map(str, staged[name].collect()))
    for name in etl.ENTITIES:
        assert {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in staged[name].inputFiles()} == {name}
        assert any(f"/{name}-" in f for f in staged["composicao_analitico"].inputFiles())
