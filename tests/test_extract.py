"""From workbook files to one wide text table with lineage."""

from __future__ import annotations

import zipfile
from datetime import datetime

import pytest

from tillweave.sources import workbooks

LOADED = datetime(2026, 1, 1)
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def book(path, sheets):
    """A workbook of inline texts and numbers; a row is a list of cells, None for none."""
    with zipfile.ZipFile(path, "w") as file:
        names = "".join(f'<sheet name="{name}" sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1))
        file.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        file.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = ""
                for c, value in enumerate(row):
                    at = f"{chr(65 + c)}{r}"
                    if isinstance(value, str):
                        cells += f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'
                    elif value is not None:
                        cells += f'<c r="{at}"><v>{value}</v></c>'
                body += f'<row r="{r}">{cells}</row>'
            file.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')


@pytest.fixture
def folder(tmp_path):
    head = ["Kod roboczy", "Nazwa", "10%"]
    book(tmp_path / "report 02.03.26.xlsx", {"Spot #1": [head, ["A-1", "Tea", 2.0], ["B", "N/A", 1.5]], "Summary": [head, ["x", "y", 9]]})
    book(tmp_path / "report 01.03.26.XLSX", {"Spot # 2 #7": [[*head, "Suma"], ["C", "Pie", None, 3]]})
    (tmp_path / "notes.txt").write_text("no workbook")
    (tmp_path / "older").mkdir()
    book(tmp_path / "older" / "report 01.01.20.xlsx", {"Spot #1": [head, ["old", "old", 1]]})
    return str(tmp_path)


def test_only_workbooks_of_the_folder_itself_are_listed(spark, folder):
    found = sorted(r["source_file"] for r in workbooks.list_workbooks(spark, folder).collect())
    assert found == ["report 01.03.26.XLSX", "report 02.03.26.xlsx"]
    assert [r["source_file"] for r in workbooks.list_files(spark, folder, "TxT").collect()] == ["notes.txt"]


def test_extract_from_files(spark, folder):
    rows = workbooks.read_reports(spark, folder, LOADED)
    assert {"Kod roboczy", "Nazwa", "10%", "Suma"} < set(rows.columns)
    found = sorted(
        (r["source_file"], r["source_sheet_clean"], r["report_date_raw"], r["spot_id_raw"], r["Kod roboczy"], r["Nazwa"], r["10%"], r["Suma"])
        for r in rows.collect()
    )
    assert found == [
        ("report 01.03.26.XLSX", "Spot#2#7", "01.03.26", 7, "C", "Pie", None, "3"),
        ("report 02.03.26.xlsx", "Spot#1", "02.03.26", 1, "A-1", "Tea", "2", None),
        ("report 02.03.26.xlsx", "Spot#1", "02.03.26", 1, "B", None, "1.5", None),
    ]
    assert {r["load_timestamp"] for r in rows.collect()} == {LOADED}


def test_extract_from_cells_on(spark):
    rows = [
        ("report 05.04.26 final.xlsx", "Spot #3", 1, 1, {"b": "1", "a": "x"}),
        ("report 05.04.26 final.xlsx", "Spot #3", 1, 2, {"b": "2", "c": "é"}),
        ("undated.xlsx", "Spot #12 ", 1, 1, {"a": "z"}),
        ("undated.xlsx", "Totals", 2, 1, {"d": "lost"}),
    ]
    cells = spark.createDataFrame(rows, workbooks.CELLS_SCHEMA)
    wide = workbooks.extract_cells(cells, LOADED)
    assert {name for name in wide.columns if len(name) == 1} == {"a", "b", "c"}
    found = sorted((r["source_file"], r["report_date_raw"] or "", r["spot_id_raw"], r["b"] or "", r["a"], r["c"]) for r in wide.collect())
    assert found == [
        ("report 05.04.26 final.xlsx", "05.04.26", 3, "1", "x", None),
        ("report 05.04.26 final.xlsx", "05.04.26", 3, "2", None, "é"),
        ("undated.xlsx", "", 12, "", "z", None),
    ]
    assert workbooks.extract_cells(cells.where("source_sheet = 'Totals'"), LOADED).count() == 0
