"""Distributed scan of report workbooks (SRC-1..7).

Spark lists and distributes the files; a task opens one workbook at a time and emits its rows as maps from
column name to cell text. Everything after that (metadata, column alignment) is plain DataFrame work.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tillweave.errors import ConfigError, SourceError
from tillweave.functions.text import quoted, strip
from tillweave.vocabulary import MISSING_CELLS

CELLS_SCHEMA = (
    "source_file STRING, source_sheet STRING, _sheet_ord INT, _row_ord BIGINT, cells MAP<STRING, STRING>"
)
_ROWS_PER_BATCH = 2_000
_MISSING = frozenset(MISSING_CELLS)
_ELIGIBLE = r"#\d+"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def list_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """SRC-1: files directly in the folder with an extension in any case, as ``(source_file, content)``."""
    anycase = "".join(f"[{x.lower()}{x.upper()}]" if x.isalpha() else x for x in extension)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{anycase}").option("recursiveFileLookup", "false")
    return files.load(folder).select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content")


def list_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder, "xlsx")


def eligible_sheet(sheet: str) -> bool:
    """SRC-2."""
    return re.search(_ELIGIBLE, sheet) is not None


def is_eligible(sheet: Column) -> Column:
    """SRC-2 on a column."""
    return F.coalesce(sheet.rlike(_ELIGIBLE), F.lit(False))


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _number_text(text: str) -> str:
    number = float(text)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        text = "".join(part.text or "" for part in cell.iter(f"{_MAIN}t"))
    else:
        value = cell.findtext(f"{_MAIN}v")
        if value is None or kind == "e":
            return None
        if kind == "s":
            text = shared[int(value)]
        elif kind == "b":
            text = "True" if value == "1" else "False"
        elif kind == "n":
            text = _number_text(value)
        else:
            text = value
    return None if text in _MISSING else text


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    # Phonetic hints (rPh) are not part of the text.
    return [
        "".join(
            part.text or ""
            for run in item
            if run.tag != f"{_MAIN}rPh"
            for part in run.iter(f"{_MAIN}t")
        )
        for item in root.iter(f"{_MAIN}si")
    ]


def _sheets(book: zipfile.ZipFile) -> list[tuple[int, str, str]]:
    """Position, name and archive member of the eligible sheets."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    found = []
    for position, sheet in enumerate(sheets):
        if eligible_sheet(sheet.get("name")):
            target = posixpath.join("/xl", targets[sheet.get(_LINK)])
            found.append((position, sheet.get("name"), target.lstrip("/")))
    return found


def _sheet_rows(book: zipfile.ZipFile, member: str, shared: list[str]) -> Iterator[dict[int, str | None]]:
    """Cells of each row by column position; rows that the file leaves out come as empty rows."""
    expected = 1
    with book.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag != f"{_MAIN}row":
                continue
            number = int(element.get("r", expected))
            while expected < number:
                expected += 1
                yield {}
            row: dict[int, str | None] = {}
            for cell in element.iter(f"{_MAIN}c"):
                position = _column_index(cell.get("r")) if cell.get("r") else len(row)
                row[position] = _cell_text(cell, shared)
            element.clear()
            expected = number + 1
            yield row


def _header_names(header: dict[int, str | None], width: int) -> list[str]:
    """Blank names become ``Unnamed: <position>``, repeated ones get ``.1``, ``.2``, …"""
    names: list[str] = []
    used: set[str] = set()
    for position in range(width):
        base = header.get(position) or f"Unnamed: {position}"
        name, repeat = base, 0
        while name in used:
            repeat += 1
            name = f"{base}.{repeat}"
        used.add(name)
        names.append(name)
    return names


def _read_workbook(source_file: str, content: bytes) -> Iterator[tuple]:
    """Rows of all eligible sheets of one workbook (SRC-3)."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            shared = _shared_texts(book)
            for sheet_ord, sheet, member in _sheets(book):
                rows = _sheet_rows(book, member, shared)
                header = next(rows, {})
                names = _header_names(header, max(header, default=-1) + 1)
                blank: list[int] = []
                for row_ord, row in enumerate(rows):
                    if all(value is None for value in row.values()):
                        blank.append(row_ord)  # kept only if a filled row follows
                        continue
                    for skipped in blank:
                        yield source_file, sheet, sheet_ord, skipped, dict.fromkeys(names)
                    blank.clear()
                    names += [f"Unnamed: {at}" for at in range(len(names), max(row) + 1)]
                    yield source_file, sheet, sheet_ord, row_ord, {
                        name: row.get(at) for at, name in enumerate(names)
                    }
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError) as bad:
        raise SourceError(f"cannot read workbook {source_file!r}: {bad}") from bad


def _read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["source_file", "source_sheet", "_sheet_ord", "_row_ord", "cells"]
    for batch in batches:
        for source_file, content in zip(batch["source_file"], batch["content"], strict=True):
            rows = []
            for row in _read_workbook(source_file, content):
                rows.append(row)
                if len(rows) == _ROWS_PER_BATCH:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def scan_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-1..3: rows of all eligible sheets in the folder, cells as a map of texts."""
    return list_workbooks(spark, folder).mapInPandas(_read_batches, CELLS_SCHEMA)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """SRC-5: the first ``dd.dd.dd`` of the file name; null where there is none."""
    # Fixed value: the format of file names.
    found = F.regexp_extract("source_file", r"([0-9]{2}\.[0-9]{2}\.[0-9]{2})", 1)
    return df.withColumn("report_date_raw", F.when(found != "", found))


def with_sheet_metadata(df: DataFrame) -> DataFrame:
    """SRC-6: sheet name without blanks around ``#``, and the spot number at its end."""
    clean = F.regexp_replace(strip(F.col("source_sheet")), r"(?U)\s*#\s*", "#")
    number = F.regexp_extract("source_sheet_clean", r"#([0-9]+)\s*\z", 1)
    return df.withColumn("source_sheet_clean", clean).withColumn("spot_id_raw", number.try_cast("int"))


def with_lineage(df: DataFrame, load_timestamp: datetime) -> DataFrame:
    """SRC-5..7. The load time is an argument, so that a repeated run gives the same rows."""
    stamped = F.lit(load_timestamp).cast(TimestampType())
    return with_sheet_metadata(with_file_metadata(df)).withColumn("load_timestamp", stamped)


def discover_columns(cells: DataFrame) -> list[str]:
    """SRC-4: all column names, in order of first appearance.

    Rows of a sheet share their header, so the headers are made distinct before they are taken apart.
    """
    place = F.shiftleft(F.col("_sheet_ord").cast("long"), 40) + F.col("_row_ord")
    headers = cells.groupBy(F.map_keys("cells").alias("header"), "source_file").agg(F.min(place).alias("place"))
    first = F.struct("source_file", "place").alias("first")
    names = (
        headers.select(first, F.posexplode("header").alias("position", "name"))
        .groupBy("name")
        .agg(F.min(F.struct("first", "position")).alias("first"))
    )
    found = [row["name"] for row in names.orderBy("first").select("name").collect()]
    if len({name.lower() for name in found}) < len(found):
        if cells.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
            raise ConfigError("column names differ by case only; set spark.sql.caseSensitive=true")
    return found


def project_cells(cells: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SRC-4: one text column per discovered name, null where a sheet lacks it."""
    names = discover_columns(cells) if columns is None else columns
    kept = [quoted(name) for name in cells.columns if name != "cells"]
    return cells.select(*kept, *(F.element_at("cells", F.lit(name)).alias(name) for name in names))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """SRC-4 for sources that are tables already: union with outer column alignment."""
    if not tables:
        raise SourceError("nothing to unite")
    united = tables[0]
    for table in tables[1:]:
        united = united.unionByName(table, allowMissingColumns=True)
    return united


def extract_cells(cells: DataFrame, load_timestamp: datetime) -> DataFrame:
    """Rows of cells of eligible sheets as one wide text table with lineage, whatever read them."""
    return project_cells(with_lineage(cells.where(is_eligible(F.col("source_sheet"))), load_timestamp))


def read_reports(spark: SparkSession, folder: str, load_timestamp: datetime) -> DataFrame:
    """All reports of a folder as one wide text table with lineage."""
    return extract_cells(scan_workbooks(spark, folder), load_timestamp)
