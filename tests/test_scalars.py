"""Numbers, dates, codes and names on edge cells."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions import dates, numbers, text
from tillweave.plans import staging
from tillweave.sources import workbooks


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_numbers(spark):
    cells = ["1,5", " 1.5 ", "abc", "1d", "NaN", "", None, "-2e1", ".5", "1,2,3"]
    assert column(spark, cells, numbers.text_to_number) == [1.5, 1.5, None, None, None, None, None, -20.0, 0.5, None]


def test_dates(spark):
    found = column(spark, ["01.03.26", "01.03.99", "31.02.26", "x", None], dates.report_date)
    assert found[0] == dt.date(2026, 3, 1) and found[2:] == [None, None, None] and found[1].month == 3


def test_codes_and_names(spark):
    assert column(spark, ["C_AB", "c-AB", "AB", None], text.clean_code) == ["AB", "AB", "AB", None]
    groups = column(spark, ["CAT01-X-3-4", "SMALL TIN-X-1-2", "c-CAT7-X-1-1", ""], text.group_of_code)
    assert groups == ["CAT01", "SMALL_TIN", "CAT7", None]
    assert column(spark, ["NA", " 12 ", "", None, "na"], text.clean_recipe) == [None, "12", None, None, None]
    assert column(spark, ["a | b||c ", ""], text.split_names) == [["a", "b", "c"], []]
    assert column(spark, ["Żółw  (é) x!"], text.normalized_name) == ["żółw_é_x"]


def test_eligible_sheets(spark):
    sheets = ["A #1", "A # 1", "A #1 old", "backup#old", None]
    assert column(spark, sheets, workbooks.is_eligible) == [True, False, True, False, False]
    assert [workbooks.eligible_sheet(x) for x in sheets[:4]] == [True, False, True, False]


def test_column_names_must_stay_apart(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Suma  ", "Suma")
    with pytest.raises(QualityError):
        staging.normalize_columns(frame)
    assert staging.normalize_columns(frame.toDF(" Suma  x ", "20%")).columns == ["Suma x", "20%"]


def test_required_columns(spark):
    with pytest.raises(QualityError, match="report_date"):
        staging.require_columns(spark.range(1), ["report_date", "id"], "input")


def test_missing_recipe_column_is_null(spark):
    rows = spark.createDataFrame([("AB", "name", dt.date(2026, 1, 2))], "`Kod roboczy` string, Nazwa string, report_date date")
    cell = staging.clean_product_cells(staging.with_product_cells(rows)).first()
    assert cell["recipe_number_clean"] is None and cell["product_work_key"] == "02_01_26_AB"


def test_spots_as_texts_and_repeated_spots(spark):
    spots = [("1.0", "One", "C", "S"), ("2", "Two", "C", "S"), ("x", "None", "C", "S")]
    schema = "spot_id_raw string, spot_name string, city string, street string"
    rows = spark.createDataFrame([(1,), (2,), (3,)], "spot_id_raw int")
    found = staging.map_spots(rows, spark.createDataFrame(spots, schema)).orderBy("spot_id_raw").collect()
    assert [(r["spot_name"], r["spot_mapping_found"]) for r in found] == [("One", True), ("Two", True), (None, False)]
    with pytest.raises(QualityError):
        staging.map_spots(rows, spark.createDataFrame([*spots, ("1", "Again", "C", "S")], schema))
