"""Cells of workbooks, read from archives by the executors.

Input is a DataFrame of files (`path`, `content`), as the binaryFile source gives it: workbooks,
or monthly archives that contain them. Each file is unpacked in memory by one task.
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cell texts that count as missing, and the names of the month's main workbook.
MISSING = frozenset((
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"))
MAIN_WORKBOOK = r"(Referência|Referencia)"

CELLS = "path string, file string, sheet string, row bigint, col int, value string"
PARSED = f"{CELLS}, problem string"
SHEETS = "path string, file string, sheet string"
MEMBERS = "path string, member string, bytes long, crc32 long, problem string"
#: Problem of a member whose path an archive has more than once.
REPEATED = "repeated name: only the last one is read"
BATCH = 20_000

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def read_files(spark: SparkSession, path: str, pattern: str = "*.{zip,xlsx}") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", True).load(path)


def _bare(name: str) -> str:
    return name.rsplit("/", 1)[-1]


def _is_workbook(archive: zipfile.ZipFile) -> bool:
    return "[Content_Types].xml" in archive.namelist()


def _members(outer: zipfile.ZipFile) -> tuple[list[zipfile.ZipInfo], list[str]]:
    """Files of an archive by their full path, and the paths that come again; of those the last one
    counts, as it does when an archive is unpacked."""
    last: dict[str, zipfile.ZipInfo] = {}
    again = []
    for info in outer.infolist():
        if info.is_dir():
            continue
        if info.filename in last:
            again.append(info.filename)
        last[info.filename] = info
    return list(last.values()), again


def _workbooks(path: str, content: bytes, main_only: bool = False) -> Iterator[tuple[str, zipfile.ZipFile | str]]:
    """(file name, opened workbook) of a file, or of the members of an archive by their full path. In place
    of a workbook stands what is wrong with a member; a path that comes again has an entry more.

    With `main_only` no more than the first main workbook, chosen by bare name and path before it is
    unpacked, and an error if it is broken; unpacking checks its checksum.
    """
    outer = zipfile.ZipFile(io.BytesIO(content))
    if _is_workbook(outer):
        if not main_only or re.search(MAIN_WORKBOOK, _bare(path)):
            yield _bare(path), outer
        return
    members, again = _members(outer)
    members = [m for m in members if m.filename.lower().endswith(".xlsx")]
    if main_only:
        members = sorted((m for m in members if re.search(MAIN_WORKBOOK, _bare(m.filename))),
                         key=lambda m: (_bare(m.filename), m.filename))[:1]
    for member in members:
        if member.filename in again:
            yield member.filename, REPEATED
        try:
            book = zipfile.ZipFile(io.BytesIO(outer.read(member)))
        except UNREADABLE as error:
            if main_only:
                raise
            book = f"{type(error).__name__}: {error}"
        yield member.filename, book


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part inside the workbook), in workbook order."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {link.get("Id"): link.get("Target") for link in links}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    parts = []
    for sheet in root.iter(f"{_MAIN}sheet"):
        part = target[sheet.get(_REL)].lstrip("/")
        parts.append((sheet.get("name"), part if part.startswith("xl/") else f"xl/{part}"))
    return parts


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if element.tag == f"{_MAIN}si":
                texts.append("".join(t.text or "" for t in element.iter(f"{_MAIN}t")))
                element.clear()
    return texts


def _position(reference: str) -> tuple[int, int]:
    """Zero-based row and column of a cell reference such as B12."""
    found = re.match(r"([A-Z]+)(\d+)", reference or "")
    if not found:
        raise ValueError(f"cell reference {reference!r}")
    letters, digits = found.groups()
    column = 0
    for letter in letters:
        column = column * 26 + ord(letter) - 64
    return int(digits) - 1, column - 1


#: What unpacking and parsing raise on broken input.
UNREADABLE = (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, OSError, EOFError, KeyError,
              ValueError, IndexError, NotImplementedError, RuntimeError)


def _sheet_cells(book: zipfile.ZipFile, part: str, texts: list[str]) -> Iterator[tuple[int, int, str]]:
    with book.open(part) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag == f"{_MAIN}c":
                kind, value = element.get("t"), element.find(f"{_MAIN}v")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))
                else:
                    text = value.text if value is not None and value.text else ""
                    if kind == "s" and text:
                        text = texts[int(text)]
                if text not in MISSING:
                    yield (*_position(element.get("r")), text)
            elif element.tag == f"{_MAIN}row":
                element.clear()


def parse(files: DataFrame, sheets: Sequence[str] | None = None, main_only: bool = False) -> DataFrame:
    """Cells and what went wrong, in one pass over the files.

    A row with a `problem` is no cell: each file has one without sheet (empty text if it was read to
    the end), and each sheet that could not be read has one; the others go on. Of cells, only those
    of the named sheets are parsed, with `main_only` only in each file's main workbook.
    """
    wanted = None if sheets is None else frozenset(sheets)
    columns = ["path", "file", "sheet", "row", "col", "value", "problem"]

    def lines(path: str, content: bytes) -> Iterator[tuple]:
        name = None
        try:
            for name, book in _workbooks(path, content, main_only):
                if isinstance(book, str):
                    yield path, name, "", None, None, None, book
                    continue
                texts = _shared_texts(book)
                for sheet, part in _sheet_parts(book):
                    if wanted is not None and sheet not in wanted:
                        continue
                    try:
                        for cell in _sheet_cells(book, part, texts):
                            yield (path, name, sheet, *cell, None)
                    except UNREADABLE as error:
                        yield path, name, sheet, None, None, None, f"{type(error).__name__}: {error}"
            problem = "" if name else "no main workbook" if main_only else "no workbook"
        except UNREADABLE as error:
            problem = f"{type(error).__name__}: {error}"
        yield path, name, None, None, None, None, problem

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                found = lines(path, content)
                while rows := list(itertools.islice(found, BATCH)):
                    yield pd.DataFrame(rows, columns=columns).astype({"row": "Int64", "col": "Int32"})

    return files.select("path", "content").mapInPandas(unpack, PARSED)


def cells(files: DataFrame, sheets: Sequence[str] | None = None, main_only: bool = False) -> DataFrame:
    """One row per non-empty cell of what can be read."""
    return parse(files, sheets, main_only).filter(F.col("problem").isNull()).drop("problem")


def sheets(files: DataFrame) -> DataFrame:
    """Sheet names of every workbook, from its directory only."""
    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, name, sheet) for path, content in zip(batch["path"], batch["content"])
                    for name, book in _workbooks(path, content) if not isinstance(book, str)
                    for sheet, _ in _sheet_parts(book)]
            yield pd.DataFrame(rows, columns=["path", "file", "sheet"])

    return files.mapInPandas(listing, SHEETS)


def members(files: DataFrame) -> DataFrame:
    """The files inside of archives, from the archives' directories only: full path, size and checksum.

    A workbook that is no archive is its own single member. `problem` says that a path comes more than
    once (a row each), or, on a row without member, why an archive cannot be opened.
    """
    def lines(path: str, content: bytes) -> Iterator[tuple]:
        try:
            outer = zipfile.ZipFile(io.BytesIO(content))
        except UNREADABLE as error:
            yield path, None, None, None, f"{type(error).__name__}: {error}"
            return
        if _is_workbook(outer):
            yield path, _bare(path), len(content), zlib.crc32(content), None
            return
        found, again = _members(outer)
        for info in outer.infolist():
            if not info.is_dir():
                yield (path, info.filename, info.file_size, info.CRC,
                       REPEATED if info.filename in again and info not in found else None)

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame(list(lines(path, content)), columns=[
                    "path", "member", "bytes", "crc32", "problem"]).astype({"bytes": "Int64", "crc32": "Int64"})

    return files.select("path", "content").mapInPandas(listing, MEMBERS)


def unpack(files: DataFrame) -> DataFrame:
    """The workbooks inside of archives as files of their own: `path`, `member`, `content`, `problem`.

    Members are handed on one by one and dealt to tasks by their path, so that a large archive is read
    by as many tasks as it has workbooks. A member that cannot be unpacked has a problem and no content.
    """
    def lines(path: str, content: bytes) -> Iterator[tuple]:
        try:
            outer = zipfile.ZipFile(io.BytesIO(content))
            if _is_workbook(outer):
                yield path, _bare(path), content, None
                return
            found, again = _members(outer)
        except UNREADABLE as error:
            yield path, None, None, f"{type(error).__name__}: {error}"
            return
        for info in found:
            if not info.filename.lower().endswith(".xlsx"):
                continue
            if info.filename in again:
                yield path, info.filename, None, REPEATED
            try:
                yield path, info.filename, outer.read(info), None
            except UNREADABLE as error:
                yield path, info.filename, None, f"{type(error).__name__}: {error}"

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for line in lines(path, content):
                    yield pd.DataFrame([line], columns=["path", "member", "content", "problem"])

    return files.select("path", "content").mapInPandas(
        single, "path string, member string, content binary, problem string").repartition("path", "member")


def member_cells(unpacked: DataFrame, sheets: Sequence[str] | None = None) -> DataFrame:
    """Cells and problems, as `parse` gives them, of unpacked workbooks; `file` is the member's path."""
    name = F.concat("path", F.lit("\n"), "member")
    found = parse(unpacked.filter(F.col("content").isNotNull()).select(name.alias("path"), "content"), sheets)
    split = F.split("path", "\n")
    read = found.withColumns({"path": split[0], "file": split[1]})
    return read.unionByName(unpacked.filter(F.col("problem").isNotNull()).select(
        "path", F.col("member").alias("file"), F.lit("").alias("sheet"), F.lit(None).cast("bigint").alias("row"),
        F.lit(None).cast("int").alias("col"), F.lit(None).cast("string").alias("value"), "problem"))


def integrity(files: DataFrame) -> DataFrame:
    """path, valido: whether the archive opens and all members pass their checksum."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for content in batch["content"]:
                try:
                    good.append(zipfile.ZipFile(io.BytesIO(content)).testzip() is None)
                except (zipfile.BadZipFile, OSError, EOFError):
                    good.append(False)
            yield pd.DataFrame({"path": batch["path"], "valido": good})

    return files.mapInPandas(check, "path string, valido boolean")
