"""Raw report rows to staging rows.

All steps but the name rollup are narrow: they add columns row by row. The rollup works on *observations*,
the distinct product cells per file, so product texts are cleaned once per distinct value and not once per row.
"""

from __future__ import annotations

import re
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions import dates, numbers, text
from tillweave.functions.text import quoted
from tillweave.operators.attach import BOUNDS, JoinBounds, attach
from tillweave.operators.materialize import owned_scratch, scratch_path, stage
from tillweave.sources.reference import SaleTypes
from tillweave.vocabulary import METRICS, NAME, RECIPE, ROW_ORDER, WORK_CODE


def require_columns(df: DataFrame, required: list[str], what: str) -> None:
    """DQ-3."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise QualityError(f"{what} lacks columns {missing}")


def percent_columns(columns: list[str]) -> list[str]:
    """PRJ-2: dynamic measure columns."""
    return [name for name in columns if "%" in name]


def normalize_columns(df: DataFrame) -> DataFrame:
    """PRJ-1: squeezed column names; two columns must not get the same name."""
    names = [re.sub(r"\s+", " ", name.strip()) for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise QualityError(f"columns have the same name after normalization: {repeated}")
    return df.toDF(*names)


def parse_dates(df: DataFrame) -> DataFrame:
    """DT-1: adds ``report_date``; rows that fail are found by ``quality.invalid_values``."""
    require_columns(df, ["report_date_raw"], "parse_dates input")
    return df.withColumn("report_date", dates.report_date(F.col("report_date_raw")))


def _as_numbers(df: DataFrame, names: list[str], *, decimal_comma: bool) -> DataFrame:
    kinds = {item.name: item.dataType for item in df.schema.fields}
    present = [name for name in dict.fromkeys(names) if name in kinds]
    return df.withColumns(
        {
            name: numbers.to_number(quoted(name), kinds[name], decimal_comma=decimal_comma)
            for name in present
        }
    )


def normalize_metrics(df: DataFrame) -> DataFrame:
    """NUM-1."""
    return _as_numbers(df, [*METRICS, *percent_columns(df.columns)], decimal_comma=True)


def spot_number(df: DataFrame) -> Column:
    """CAST-2: spot ids as numbers, whether they come as numbers or as texts such as ``"1.0"``; else null."""
    number = numbers.to_number(F.col("spot_id_raw"), df.schema["spot_id_raw"].dataType, decimal_comma=False)
    return F.when(number == F.floor(number), number.cast("long"))


def map_spots(df: DataFrame, spots: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """JN-1: adds ``spot_name, city, street, spot_mapping_found``.

    ``spots`` must be unique on ``spot_id_raw``, else the run ends. Rows without a spot keep nulls and the flag false.
    ``counts`` are those of ``attach``, by the spot ids as numbers.
    """
    require_columns(df, ["spot_id_raw"], "map_spots input")
    require_columns(spots, ["spot_id_raw", "spot_name", "city", "street"], "spots")
    lookup = spots.select(spot_number(spots).alias("spot_id_raw"), "spot_name", "city", "street")
    repeated = lookup.groupBy("spot_id_raw").count().where("spot_id_raw IS NOT NULL AND count > 1")
    if not repeated.isEmpty():
        raise QualityError("spots have the same spot_id_raw")
    rows = df.withColumn("spot_id_raw", spot_number(df))
    return attach(rows, lookup.where("spot_id_raw IS NOT NULL"), "spot_id_raw", unique=True, counts=counts).withColumn(
        "spot_mapping_found", F.col("spot_name").isNotNull()
    )


def total_columns(columns: list[str], config: SaleTypes, percent: list[str]) -> list[str]:
    """PRJ-3: columns that make up the computed total, given the columns before grouping."""
    consumed = {name for rule in config.grouped for name in rule.source_columns if name in columns}
    present = {*columns, *(rule.target_column for rule in config.grouped)}
    fixed = [
        item.source_column
        for item in config.fixed
        if item.source_column in present and item.source_column not in consumed
    ]
    targets = [rule.target_column for rule in config.grouped]
    return list(dict.fromkeys([*fixed, *percent, *targets]))


def enrich_sales_types(df: DataFrame, config: SaleTypes) -> DataFrame:
    """NUM-2..6: grouped columns, computed total, and its difference to the control total."""
    percent = percent_columns(df.columns)
    before = list(df.columns)
    sources = [item.source_column for item in config.fixed]
    grouped_sources = [name for rule in config.grouped for name in rule.source_columns]
    out = _as_numbers(
        df, [*sources, *percent, *grouped_sources, *config.control_columns], decimal_comma=False
    )

    consumed_columns = list(before)
    for rule in config.grouped:
        # A target without any source is 0, even where the report has a column of that name.
        existing = [name for name in rule.source_columns if name in out.columns]
        out = out.withColumn(
            rule.target_column, numbers.null_as_zero_sum([quoted(name) for name in existing])
        )
        consumed_columns.append(rule.target_column)

    totals = total_columns(consumed_columns, config, percent)
    excluded = [
        F.coalesce(quoted(rule.column).cast("string").isin(*rule.values), F.lit(False))
        for rule in config.exclusions
        if rule.column in out.columns and rule.values
    ]
    out = out.withColumns(
        {
            "sales_total_computed": numbers.null_as_zero_sum([quoted(name) for name in totals]),
            "sales_validation_excluded": reduce(or_, excluded, F.lit(False)),
        }
    )

    control = config.control_columns[0] if config.control_columns else None
    if control not in out.columns:
        return out.withColumns(
            {
                "sales_total_difference": F.lit(None).cast("double"),
                "sales_total_matches_control": F.lit(None).cast("boolean"),
            }
        )
    difference = F.coalesce(quoted(control), F.lit(0.0)) - F.col("sales_total_computed")
    return out.withColumn("sales_total_difference", difference).withColumn(
        "sales_total_matches_control", F.col("sales_total_difference") == 0
    )


#: The raw product cells of a row.
CELLS = ("product_code_raw", "product_name_raw", "recipe_number_raw")


def with_product_cells(df: DataFrame) -> DataFrame:
    """PRJ-5: the raw product cells under stable names; a missing recipe column is null."""
    require_columns(df, [WORK_CODE, NAME, "report_date"], "product cleaning input")
    recipe = quoted(RECIPE).cast("string") if RECIPE in df.columns else F.lit(None).cast("string")
    return df.withColumns(
        {
            "product_code_raw": quoted(WORK_CODE).cast("string"),
            "product_name_raw": quoted(NAME).cast("string"),
            "recipe_number_raw": recipe,
        }
    )


def clean_product_cells(df: DataFrame) -> DataFrame:
    """STR-1..7: everything that follows from one row's own product cells."""
    col = F.col
    steps = [
        {
            "_code": text.squeeze(col("product_code_raw")),
            "_name": text.squeeze(col("product_name_raw")),
            "_recipe": text.strip(col("recipe_number_raw")),
        },
        {
            "is_heated": text.has_heated_mark(col("_code")),
            "_unmarked": text.without_heated_mark(col("_code")),
            "recipe_number_clean": text.recipe_or_null(col("_recipe")),
        },
        {"product_code_clean": text.without_placeholders(col("_unmarked"))},
        {
            "product_name_clean": F.coalesce(text.without_placeholders(col("_name")), "product_code_clean"),
            "has_recipe_number": col("recipe_number_clean").isNotNull(),
            "product_work_key": text.work_key(
                col("recipe_number_clean"), col("report_date"), col("product_code_clean")
            ),
            "_upper": F.upper("product_code_clean"),  # squeezed already
        },
        {"_category": text.category_of_upper(col("_upper")), "_words": text.words_of_upper(col("_upper"))},
        {
            "product_identity_basis": F.when(col("has_recipe_number"), "RECIPE_NUMBER").otherwise("DATE_CODE"),
            "product_group_fallback": text.group_from(col("_category"), col("_words")),
        },
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*(name for step in steps for name in step if name.startswith("_")))


def prepare_rows(
    raw: DataFrame, spots: DataFrame | None, sale_types: SaleTypes, *, products: bool = True
) -> DataFrame:
    """All narrow staging steps. ``spots=None`` leaves the spot attributes out."""
    rows = raw.transform(normalize_columns).transform(parse_dates).transform(normalize_metrics)
    if spots is not None:
        rows = map_spots(rows, spots)
    rows = enrich_sales_types(rows, sale_types)
    return rows.transform(with_product_cells).transform(clean_product_cells) if products else rows


def row_order(df: DataFrame) -> list[str]:
    return [name for name in ROW_ORDER if name in df.columns]


def product_observations(rows: DataFrame) -> DataFrame:
    """Distinct raw product cells per file, with their number of rows and their first row.

    ``rows`` needs ``report_date``, the product cells of ``with_product_cells`` and the row order columns.
    The aggregate is a plain hash aggregate with a partial step before the shuffle, so a cell combination that
    holds a large part of all rows reaches the shuffle as one row per task.
    """
    # Sheet and row in one decimal: the minimum of a fixed-width number needs no sort.
    place = F.col("_sheet_ord").cast("decimal(10,0)") * F.lit(Decimal(10**19)) + F.col(
        "_row_ord"
    ).cast("decimal(19,0)")
    cells = rows.groupBy(
        "source_file", "report_date", "product_code_raw", "product_name_raw", "recipe_number_raw"
    ).agg(F.count("*").alias("n_rows"), F.min(place).alias("place"))
    return _with_first_row(clean_product_cells(cells))


def _with_first_row(observations: DataFrame) -> DataFrame:
    first = F.struct(
        F.col("report_date").isNull().alias("undated"), "report_date", "source_file", "place"
    )
    return observations.withColumn("first_row", first).drop("place")


def staged_observations(rows: DataFrame) -> DataFrame:
    """``product_observations`` written once; ``first_row``, which repeats other columns, is put together on reading."""
    observations = product_observations(rows)
    flat = observations.withColumn("place", F.col("first_row.place")).drop("first_row")
    return _with_first_row(stage(flat, "observations")).select(observations.columns)


def name_rollup(named: DataFrame) -> DataFrame:
    """AGG-1, AGG-2: per work key the longest name, and all names in order.

    Names are made distinct before they are collected: a key gathers each of its names once.
    """
    name = text.strip(F.col("product_name_clean"))
    distinct = (
        named.select("product_work_key", F.when(name != "", name).alias("name")).distinct()
    )
    names = distinct.groupBy("product_work_key").agg(F.array_sort(F.collect_list("name")).alias("alternative_names"))
    longest = F.array_min(F.transform("alternative_names", lambda name: F.struct(-F.length(name), name.alias("name"))))
    return names.select("product_work_key", longest["name"].alias("product_name_selected"), "alternative_names")


def with_corrections(names: DataFrame, corrections: DataFrame) -> DataFrame:
    """CASE-1, JN-9: canonical name and group of a selected name."""
    require_columns(
        corrections, ["source_name", "canonical_name", "canonical_group", "action"], "name corrections"
    )
    lookup = corrections.select(
        F.col("source_name").alias("product_name_selected"),
        F.col("canonical_name").alias("_name"),
        F.col("canonical_group").alias("product_canonical_group"),
        F.col("action").alias("_action"),
        F.lit(True).alias("_listed"),
    )
    selected = F.col("product_name_selected")
    changed = (F.col("_name") != selected) | (F.col("_action") == "replace")
    return (
        attach(names, lookup, "product_name_selected")
        .withColumns(
            {
                "product_name_canonical": F.when(F.col("_listed"), F.col("_name")).otherwise(selected),
                "product_name_corrected": F.coalesce(F.col("_listed") & changed, F.lit(False)),
                "product_correction_action": F.when(F.col("_listed"), F.col("_action")).when(
                    selected.isNotNull(), "keep"
                ),
            }
        )
        .drop("_name", "_action", "_listed")
    )


def product_names(named: DataFrame, corrections: DataFrame) -> DataFrame:
    """One row per work key: chosen name, all names, correction."""
    names = with_corrections(name_rollup(named), corrections)
    return names.withColumns(
        {
            "product_alternative_names": text.join_names(F.col("alternative_names")),
            "product_alternative_names_count": F.size("alternative_names"),
        }
    )


def with_product_flags(df: DataFrame) -> DataFrame:
    """STR-8, STR-9."""
    group = F.coalesce("product_canonical_group", "product_group_fallback")
    df = df.withColumn("product_group_final", group)
    selected, final = F.col("product_name_selected"), F.col("product_group_final")
    return df.withColumns(
        {
            "is_system_product": text.is_system(final),
            "is_product_name_missing": selected.isNull(),
            "is_product_code_missing": F.col("product_code_clean").isNull(),
            "is_short_product_name_warning": text.is_short_name(selected, final),
        }
    )


def clean_products(
    df: DataFrame, corrections: DataFrame, names: DataFrame | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Product cleaning with the per-key results written back to the rows (JN-10).

    ``names`` is a staged result of ``product_names``; without it the join is left to Spark, which drops it altogether
    where no name column is read. ``counts`` are those of ``with_names``.
    """
    rows = df.transform(with_product_cells).transform(clean_product_cells)
    if names is not None:
        return with_names(rows, names, counts)
    lookup = product_names(rows, corrections).drop("alternative_names")
    return with_product_flags(rows.join(lookup, "product_work_key", "left"))


def with_names(rows: DataFrame, names: DataFrame, counts: DataFrame | None = None, bounds: JoinBounds = BOUNDS) -> DataFrame:
    """JN-10 for rows that ``prepare_rows`` made; ``counts`` (product_work_key, n_rows) tells which keys are hot."""
    lookup = names.drop("alternative_names")
    return with_product_flags(attach(rows, lookup, "product_work_key", unique=True, counts=counts, bounds=bounds))


def build_staging(
    raw: DataFrame,
    spots: DataFrame,
    sale_types: SaleTypes,
    corrections: DataFrame,
    *,
    names: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
) -> DataFrame:
    """The staging table: one row per report row.

    Product cells are made distinct and counted first; names come from them, or are given, as those of a longer time,
    and then reduced to the keys at hand. The counts also say which keys are joined with salts. Spots are attached last,
    so that neither the observations nor the join with the names move their texts.
    """
    spark = raw.sparkSession
    rows = prepare_rows(raw, None, sale_types)
    names_path, counts_path = scratch_path(spark, "names"), scratch_path(spark, "counts")
    with owned_scratch(spark):  # observations go as soon as names and counts are written
        observations = staged_observations(rows)
        if names is None:
            names = product_names(observations, corrections)
        else:
            names = names.join(observations.select("product_work_key"), "product_work_key", "left_semi")
        names = stage(names, "names", names_path)
        counts = stage(observations.select("product_work_key", "n_rows"), "counts", counts_path)
    return with_spots(with_names(rows, names, counts, bounds), spots, rows, "report_date")


def with_spots(named: DataFrame, spots: DataFrame, rows: DataFrame, after: str) -> DataFrame:
    """JN-1 for ``rows`` that have got their names: the columns of the spots follow the column ``after``.

    Rows are counted by spot, where they must be, as they were before their names were joined.
    """
    number = rows.select(spot_number(rows).alias("spot_id_raw"))
    mapped = map_spots(named, spots, number.groupBy("spot_id_raw").agg(F.count("*").alias("n_rows")))
    new = [name for name in mapped.columns if name not in named.columns]
    first = ["product_work_key", "spot_id_raw"]
    others = [name for name in named.columns if name not in first]
    at = others.index(after) + 1
    return mapped.select(*(quoted(name) for name in [*first, *others[:at], *new, *others[at:]]))
