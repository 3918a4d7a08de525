"""Configuration tables read from JSON (SRC-8).

Tables that are joined stay DataFrames. Settings that decide which columns a plan has (sale types, rules,
calendar names) become small frozen objects, because plans are static once they are built.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillweave.errors import ConfigError

SPOTS_SCHEMA = "spot_id_raw STRING, spot_name STRING, city STRING, street STRING"
MOVEMENT_TYPES_SCHEMA = (
    "movement_type_column STRING, movement_type_name STRING, movement_direction STRING,"
    " is_additional_detail BOOLEAN, parent_movement_type_column STRING"
)
CORRECTIONS_SCHEMA = "source_name STRING, canonical_name STRING, canonical_group STRING, action STRING"


@dataclass(frozen=True)
class FixedSaleType:
    source_column: str
    sale_type_code: str
    sale_type_name: str


@dataclass(frozen=True)
class GroupedColumn:
    target_column: str
    source_columns: tuple[str, ...]


@dataclass(frozen=True)
class Exclusion:
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class SaleTypes:
    fixed: tuple[FixedSaleType, ...]
    grouped: tuple[GroupedColumn, ...] = ()
    control_columns: tuple[str, ...] = ()
    exclusions: tuple[Exclusion, ...] = ()


@dataclass(frozen=True)
class SourceRule:
    """Condition lists left as None are not tested; the others must all hold."""

    rule_name: str
    priority: int
    source: str
    has_recipe_number: bool | None = None
    product_code_contains: tuple[str, ...] | None = None
    product_name_in: tuple[str, ...] | None = None
    product_name_regex: tuple[str, ...] | None = None
    product_group_in: tuple[str, ...] | None = None


@dataclass(frozen=True)
class SourceRules:
    default_source: str
    rules: tuple[SourceRule, ...] = ()

    def __post_init__(self) -> None:
        if not self.default_source.strip():
            raise ConfigError("default_source must not be empty")
        for rule in self.rules:
            if not rule.rule_name.strip() or not rule.source.strip():
                raise ConfigError(f"rule needs a name and a source: {rule}")
            for texts in (
                rule.product_code_contains,
                rule.product_name_in,
                rule.product_name_regex,
                rule.product_group_in,
            ):
                if texts is not None and any(not text.strip() for text in texts):
                    raise ConfigError(f"rule {rule.rule_name!r} has an empty condition text")


@dataclass(frozen=True)
class CalendarNames:
    months: Mapping[int, str] = field(default_factory=dict)
    days: Mapping[int, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # Every date range of a week or a year needs all of them; a short range may need fewer (DQ-1 tells).
        if any(not 1 <= month <= 12 for month in self.months) or any(not 1 <= day <= 7 for day in self.days):
            raise ConfigError("month names are numbered 1..12 and day names 1..7")


def read_reference(spark: SparkSession, path: str, schema: str | StructType, *, lines: bool = False) -> DataFrame:
    """A JSON file with a list of objects, or with one object, under a given schema.

    ``lines`` is for large tables: a file or a folder of files with one object a line, which Spark splits among tasks. A
    text that is no object of the schema ends the job, wherever it is.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=not lines)


def _single(df: DataFrame, path: str, required: list[str]) -> Row:
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ConfigError(f"{path} must hold exactly one JSON object")
    missing = [name for name in required if rows[0][name] is None]
    if missing:
        raise ConfigError(f"{path} lacks {missing}")
    return rows[0]


def _filled(item: Row, names: list[str], path: str) -> Row:
    missing = [name for name in names if item is None or item[name] is None]
    if missing:
        raise ConfigError(f"an entry of {path} lacks {missing}")
    return item


def load_spots(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    return read_reference(spark, path, SPOTS_SCHEMA, lines=lines)


def load_movement_types(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    return read_reference(spark, path, MOVEMENT_TYPES_SCHEMA, lines=lines)


def load_name_corrections(spark: SparkSession, path: str) -> DataFrame:
    schema = "name_corrections MAP<STRING, STRUCT<canonical_name: STRING, canonical_group: STRING, action: STRING>>"
    source = read_reference(spark, path, schema)
    return source.select(F.explode("name_corrections").alias("source_name", "entry")).select(
        "source_name", "entry.canonical_name", "entry.canonical_group", "entry.action"
    )


def load_sale_types(spark: SparkSession, path: str) -> SaleTypes:
    schema = (
        "fixed_sale_types ARRAY<STRUCT<source_column: STRING, sale_type_code: STRING, sale_type_name: STRING>>,"
        "grouped_columns ARRAY<STRUCT<target_column: STRING, source_columns: ARRAY<STRING>>>,"
        "control_columns ARRAY<STRUCT<source_column: STRING, control_code: STRING, description: STRING>>,"
        "validation_exclusions ARRAY<STRUCT<column: STRING, values: ARRAY<STRING>, description: STRING>>"
    )
    row = _single(
        read_reference(spark, path, schema),
        path,
        ["fixed_sale_types", "grouped_columns", "control_columns"],
    )
    fixed = [
        _filled(item, ["source_column", "sale_type_code", "sale_type_name"], path)
        for item in row["fixed_sale_types"]
    ]
    grouped = [_filled(item, ["target_column", "source_columns"], path) for item in row["grouped_columns"]]
    control = [_filled(item, ["source_column"], path) for item in row["control_columns"]]
    excluded = [_filled(item, ["column", "values"], path) for item in row["validation_exclusions"] or []]
    return SaleTypes(
        fixed=tuple(FixedSaleType(*item) for item in fixed),
        grouped=tuple(GroupedColumn(item[0], tuple(item[1])) for item in grouped),
        control_columns=tuple(item["source_column"] for item in control),
        exclusions=tuple(Exclusion(item["column"], tuple(item["values"])) for item in excluded),
    )


def load_source_rules(spark: SparkSession, path: str) -> SourceRules:
    lists = ("product_code_contains", "product_name_in", "product_name_regex", "product_group_in")
    conditions = "has_recipe_number: BOOLEAN, " + ", ".join(f"{name}: ARRAY<STRING>" for name in lists)
    schema = (
        "default_source STRING, rules ARRAY<STRUCT<rule_name: STRING, priority: INT, source: STRING,"
        f" conditions: STRUCT<{conditions}>>>"
    )
    row = _single(read_reference(spark, path, schema), path, ["default_source", "rules"])
    rules = []
    for item in row["rules"]:
        _filled(item, ["rule_name", "priority", "source", "conditions"], path)
        tested = item["conditions"]
        rules.append(
            SourceRule(
                rule_name=item["rule_name"].strip(),
                priority=item["priority"],
                source=item["source"].strip(),
                has_recipe_number=tested["has_recipe_number"],
                **{name: None if tested[name] is None else tuple(tested[name]) for name in lists},
            )
        )
    return SourceRules(row["default_source"].strip(), tuple(rules))


def load_calendar_names(spark: SparkSession, path: str) -> CalendarNames:
    schema = "month_names MAP<STRING, STRING>, day_names MAP<STRING, STRING>"
    row = _single(read_reference(spark, path, schema), path, ["month_names", "day_names"])
    try:
        return CalendarNames(
            months={int(number): name.strip() for number, name in row["month_names"].items()},
            days={int(number): name.strip() for number, name in row["day_names"].items()},
        )
    except ValueError as bad:
        raise ConfigError(f"{path} has a month or day that is no number: {bad}") from bad
