"""Dimensions that come from configuration or from the reports' dates and column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions import dates, text
from tillweave.operators.surrogate import assign_ids
from tillweave.plans.staging import percent_columns, require_columns, spot_number
from tillweave.sources.reference import CalendarNames, SaleTypes
from tillweave.vocabulary import DIRECTIONS


def calendar(days: DataFrame, names: CalendarNames) -> DataFrame:
    """DT-3..5: attributes of a table of distinct days in column ``date``."""
    day = F.col("date")
    weekday = dates.iso_weekday(day)
    return days.select(
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        dates.localized(F.month(day), names.months).alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        dates.localized(weekday, names.days).alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        dates.year_month(day).alias("year_month"),
        dates.iso_year_week(day).alias("year_week"),
    )


def build_dim_date(staging: DataFrame, names: CalendarNames) -> DataFrame:
    """GEN-1: every day from the first to the last report date."""
    require_columns(staging, ["report_date"], "dim_date input")
    bounds = staging.agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return calendar(days, names)


def build_dim_spot(spots: DataFrame) -> DataFrame:
    require_columns(spots, ["spot_id_raw", "spot_name", "city", "street"], "spots")
    clean = spots.select(
        spot_number(spots).cast("int").alias("spot_id_raw"),
        text.tidy(F.col("spot_name")).alias("spot_name"),
        text.tidy(F.col("street")).alias("address"),
        text.tidy(F.col("city")).alias("city"),
    )
    return assign_ids(clean, "spot_id", [F.col("spot_id_raw")])


def build_dim_movement_type(movement_types: DataFrame) -> DataFrame:
    """SRT-1. The table is checked by ``quality.movement_type_issues``."""
    columns = ["movement_type_column", "movement_type_name", "movement_direction"]
    require_columns(
        movement_types, [*columns, "is_additional_detail", "parent_movement_type_column"], "movement types"
    )
    clean = movement_types.select(
        *(text.tidy(F.col(name)).alias(name) for name in columns),
        F.col("is_additional_detail").cast("boolean").alias("is_additional_detail"),
        text.tidy(F.col("parent_movement_type_column")).alias("parent_movement_type_column"),
    )
    order = ["is_additional_detail", "movement_direction", "movement_type_name", "movement_type_column"]
    return assign_ids(clean, "movement_type_id", [F.col(name) for name in order])


def missing_parents(movement_types: DataFrame) -> DataFrame:
    """SET-2: parent columns that are no movement column."""
    parents = movement_types.select(F.col("parent_movement_type_column").alias("missing_parent"))
    known = movement_types.select(F.col("movement_type_column").alias("missing_parent"))
    return parents.where("missing_parent IS NOT NULL").distinct().join(known, "missing_parent", "left_anti")


def invalid_directions(movement_types: DataFrame) -> DataFrame:
    """SET-3: directions that are not allowed."""
    direction = text.tidy(F.col("movement_direction"))
    return (
        movement_types.select(direction.alias("movement_direction"))
        .where(~F.col("movement_direction").isin(*DIRECTIONS))
        .distinct()
    )


def discount_percent(column: str) -> int:
    """STR-14 on a column name."""
    # Fixed value: the format of discount columns.
    found = re.search(r"(\d+)\s*%", column)
    if found is None:
        raise QualityError(f"cannot read a discount percentage from column {column!r}")
    return int(found.group(1))


def build_dim_sale_type(staging: DataFrame, config: SaleTypes) -> DataFrame:
    """SET-1, SRT-2: fixed sale types of the configuration and the discount columns of the reports."""
    target = {
        source: rule.target_column for rule in config.grouped for source in rule.source_columns
    }
    fixed: dict[str, tuple] = {}
    for item in config.fixed:
        source = target.get(item.source_column, item.source_column)
        entry = (item.sale_type_code, item.sale_type_name, source, "FIXED", False, None)
        fixed.setdefault(item.sale_type_code, entry)
    discounts = [
        (f"DISCOUNT_{discount_percent(name)}", name, name, "DISCOUNT", True, discount_percent(name))
        for name in percent_columns(staging.columns)
    ]
    rows = [*fixed.values(), *discounts]
    if not rows:
        raise QualityError("there is no sale type")
    codes = [row[0] for row in rows]
    repeated = sorted({code for code in codes if codes.count(code) > 1})
    if repeated:
        raise QualityError(f"sale type codes occur more than once: {repeated}")

    # As many rows as the reports have columns.
    dim = staging.sparkSession.createDataFrame(
        rows,
        "sale_type_code STRING, sale_type_name STRING, source_column STRING, sale_type_kind STRING,"
        " is_dynamic BOOLEAN, discount_pct INT",
    )
    code = F.col("sale_type_code")
    rank = F.when(code == "FULL_PRICE", 1).when(code == "TGTG", 2).when(code.startswith("DISCOUNT_"), 3)
    position = Window.orderBy(F.coalesce(rank, F.lit(9)), F.coalesce("discount_pct", F.lit(0)), code)
    return dim.select(
        F.row_number().over(position).alias("sale_type_id"), "*", F.lit(True).alias("is_active")
    )
