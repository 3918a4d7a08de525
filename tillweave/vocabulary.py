"""Names and values fixed by the report format and by the published model."""

from __future__ import annotations

# Column names of the daily report.
WORK_CODE = "Kod roboczy"
NAME = "Nazwa"
RECIPE = "Kod wewnętrzny"
RECEIVED = "Przyjęto"
RETURNED = "Zwrócono"
GROSS = "Brutto"
UNIT_COST = "koszt-jednostka"
RECEIPT_COST = "koszt-przyjęcie"

# Columns that hold numbers wherever they occur.
METRICS = (
    "Przyjęto",
    "Sprzedaż",
    "Suma",
    "Brutto",
    "Zwrócono",
    "koszt-jednostka",
    "koszt-przyjęcie",
    "Paczki",
    "Paczki 1",
    "Paczki 2",
    "Uszkodzenia - Przyjęcie",
    "Uszkodzenia - Zwrot",
)

# Texts that mean "no value" in a name or code.
MISSING_TEXT = ("", "0", ")")

# Cell texts that a spreadsheet reader takes as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The group name of technical products, and the separator of joined names.
SYSTEM_GROUP = "SYSTEM"
NAME_SEPARATOR = " | "

# Movement directions.
DIRECTIONS = ("IN", "OUT")

LINEAGE = (
    "source_file",
    "source_sheet",
    "source_sheet_clean",
    "report_date_raw",
    "spot_id_raw",
    "load_timestamp",
)

# Row order inside the whole extract: files by name, then sheets, then rows.
ROW_ORDER = ("source_file", "_sheet_ord", "_row_ord")

# Sums are taken on decimals, so that their result does not depend on the order of addition.
MEASURE = "decimal(28,8)"
