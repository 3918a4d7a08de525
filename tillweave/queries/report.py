"""Daily reports derived from the driver's tables, in the messy shape that workbooks have.

Every line item becomes one report row: the ship date is the report, the supplier the sheet, the part the product.
All line items take part. Product cells and numbers get the defects that the staging steps exist for.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.operators.attach import BOUNDS, estimated_bytes
from tillweave.plans.staging import prepare_rows
from tillweave.plans.warehouse import ProductModel, Settings, build_product_model
from tillweave.sources.reference import (
    CORRECTIONS_SCHEMA,
    MOVEMENT_TYPES_SCHEMA,
    CalendarNames,
    FixedSaleType,
    GroupedColumn,
    SaleTypes,
    SourceRule,
    SourceRules,
)

LOADED = datetime(2026, 1, 1)
NBSP = "\u00a0"

# Sale types, movement types and calendar names of the published configuration.
SALE_TYPES = SaleTypes(
    fixed=(
        FixedSaleType("Sprzedaż", "FULL_PRICE", "Sprzedaż pełnopłatna"),
        FixedSaleType("Paczki 1", "TGTG", "Paczki"),
        FixedSaleType("Paczki 2", "TGTG", "Paczki"),
    ),
    grouped=(GroupedColumn("Paczki", ("Paczki 1", "Paczki 2")),),
    control_columns=("Suma",),
)
MOVEMENT_TYPES = [
    ("Przyjęto", "Przyjęto", "IN", False, None),
    ("Zwrócono", "Zwrócono", "OUT", False, None),
    ("Uszkodzenia - Przyjęcie", "Przyjęto - Uszkodzenia", "IN", True, "Przyjęto"),
    ("Uszkodzenia - Zwrot", "Zwrócono - Uszkodzenia", "OUT", True, "Zwrócono"),
]
CALENDAR = CalendarNames(
    months=dict(
        enumerate(
            (
                "styczeń", "luty", "marzec", "kwiecień", "maj", "czerwiec",
                "lipiec", "sierpień", "wrzesień", "październik", "listopad", "grudzień",
            ),
            start=1,
        )
    ),
    days=dict(
        enumerate(
            ("poniedziałek", "wtorek", "środa", "czwartek", "piątek", "sobota", "niedziela"), start=1
        )
    ),
)

# Rules and corrections of these reports, one of each kind, on words that the part names and types contain.
RULES = SourceRules(
    "Unsorted",
    (
        SourceRule("numbered", 1, "INSIDE", has_recipe_number=True),
        SourceRule("catalogue code", 2, "OUTSIDE", product_code_contains=("-x-",)),
        SourceRule("named", 3, "LISTED", product_name_in=("Old Rod", "hot ring")),
        SourceRule("a pattern and a group", 3, "PATTERN", product_name_regex=(r"^small .*t$", "^BLUE "), product_group_in=("PROMO", "LARGE")),
        SourceRule("unnumbered of a group", 4, "GROUPED", has_recipe_number=False, product_group_in=("ECONOMY",)),
    ),
)
CORRECTIONS = [
    ("red plate", "Red Plate", "PLATES", "replace"),
    ("blue ring", "blue ring", "RINGS", "keep"),
    ("old rod", "old rod", "RODS", "replace"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """The driver's tables are single files that can't be split: without this one task would read all of a table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per line item; some measures are numbers, some are texts with a decimal comma."""
    parts = table(spark, sf_dir, "part")
    if estimated_bytes(parts) > BOUNDS.broadcast_bytes // 4:  # too large for Spark to broadcast: lines are shuffled, but need no sort
        parts = parts.hint("shuffle_hash")
    lines = _spread(table(spark, sf_dir, "lineitem")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    line, tax, discount = F.col("l_linenumber"), F.col("l_tax"), F.col("l_discount")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    plain_code = F.concat_ws("-", "p_type", "p_size")
    code = (
        F.when(line == 1, F.concat(F.lit("C_"), plain_code))
        .when(line == 2, F.concat(F.lit("  c-"), plain_code, F.lit(NBSP)))
        .when((line == 3) & (tax == 0.08), F.lit(None))
        .when((line == 7) & (F.col("p_size") <= 25), F.lit("CAT01-X-3-4"))
        .when(line == 7, F.concat(F.lit("CAT02-X-"), "p_size", F.lit("-4")))
        .otherwise(plain_code)
    )
    name = (
        F.when(tax == 0.0, F.lit(")"))
        .when(tax == 0.01, F.concat(F.lit(NBSP), F.regexp_replace("p_name", " ", "  "), F.lit("\t")))
        .when(tax == 0.02, F.upper("p_name"))
        .when((tax == 0.03) & (line == 4), F.concat_ws(" | ", "p_name", "p_type"))
        .otherwise(F.col("p_name"))
    )
    recipe = F.when(F.col("p_size") <= 5, F.concat(F.lit(" "), F.col("p_partkey").cast("string"))).when(
        line == 5, "NA"
    )
    day = F.date_format("l_shipdate", "dd.MM.yy")
    sold = {
        "Sprzedaż": F.when(discount == 0.0, F.when(tax == 0.08, "abc").otherwise(_comma(quantity))),
        "Paczki 1": F.when(discount == 0.01, quantity),
        "Paczki 2": F.when(discount == 0.02, quantity),
        **{f"{pct}%": F.when(F.round(discount * 100) == pct, quantity) for pct in range(3, 11)},
    }
    return lines.select(
        F.concat(F.lit("report "), day, F.lit(".xlsx")).alias("source_file"),
        F.concat(F.lit("Spot #"), "l_suppkey").alias("source_sheet"),
        F.concat(F.lit("Spot#"), "l_suppkey").alias("source_sheet_clean"),
        day.alias("report_date_raw"),
        F.col("l_suppkey").alias("spot_id_raw"),
        F.lit(LOADED).alias("load_timestamp"),
        F.col("l_suppkey").cast("int").alias("_sheet_ord"),
        ((F.col("l_orderkey") * 10 + line) * 10_000_000 + F.col("l_partkey")).alias("_row_ord"),
        code.alias("Kod roboczy"),
        name.alias(" Nazwa  "),
        recipe.alias("Kod wewnętrzny"),
        *(column.alias(label) for label, column in sold.items()),
        F.when(tax != 0.07, quantity).alias("Suma"),
        _comma(F.col("l_extendedprice")).alias("Brutto"),
        F.when(flag == "N", quantity).alias("Przyjęto"),
        F.when(flag == "R", quantity).alias("Zwrócono"),
        F.when(flag == "A", quantity).alias("Uszkodzenia - Zwrot"),
        F.when(discount < 0.09, _comma(F.col("p_retailprice") + tax)).alias("koszt-jednostka"),
        F.when(
            (flag == "N") & (F.col("l_linestatus") == "O"), quantity * F.col("p_retailprice")
        ).alias("koszt-przyjęcie"),
    )


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows after all narrow staging steps but the spot attributes."""
    return prepare_rows(report(spark, sf_dir), None, SALE_TYPES)


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("spot_id_raw"),
        F.concat(F.lit(" "), F.regexp_replace("s_name", "#", "  #")).alias("spot_name"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("ul. "), "s_suppkey").alias("street"),
    )


def corrections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CORRECTIONS, CORRECTIONS_SCHEMA)


def movement_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MOVEMENT_TYPES, MOVEMENT_TYPES_SCHEMA)


def settings(spark: SparkSession, sf_dir: str) -> Settings:
    return Settings(
        spots=spots(spark, sf_dir),
        movement_types=movement_types(spark),
        sale_types=SALE_TYPES,
        source_rules=RULES,
        corrections=corrections(spark),
        calendar_names=CALENDAR,
    )


def model(spark: SparkSession, sf_dir: str) -> ProductModel:
    return build_product_model(rows(spark, sf_dir), corrections(spark), RULES)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows as cell maps whose keys differ by row: the sale column follows from the discount."""
    discount = F.col("l_discount")
    sale_column = (
        F.when(discount == 0.0, "Sprzedaż")
        .when(discount == 0.01, "Paczki 1")
        .when(discount == 0.02, "Paczki 2")
        .otherwise(F.concat(F.round(discount * 100).cast("int").cast("string"), F.lit("%")))
    )
    pairs = [
        (F.lit("Kod roboczy"), F.col("l_partkey").cast("string")),
        (F.lit("Kod zamówienia"), F.concat_ws("/", "l_orderkey", "l_linenumber")),
        (sale_column, _comma(F.col("l_quantity"))),
    ]
    entries = F.create_map(*reduce(lambda flat, pair: [*flat, *pair], pairs, []))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("report "), F.date_format("l_shipdate", "dd.MM.yy"), F.lit(".xlsx")).alias("source_file"),
        F.concat(F.when(F.col("l_orderkey") % 2 == 0, " Spot  # ").otherwise(" Spot  #"), "l_suppkey").alias("source_sheet"),
        F.col("l_suppkey").cast("int").alias("_sheet_ord"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_row_ord"),
        entries.alias("cells"),
    )
