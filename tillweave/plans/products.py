"""Product dimension (AGG-4..9, RULE-1, RULE-2).

Rows are first reduced to *variants*: distinct product cells with their number of rows and their first row.
Everything else is a combinable aggregate over variants. Rule conditions are evaluated per variant and combined with
``bool_or``, so no product ever gathers its codes or names for the rules.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.functions import text
from tillweave.operators.attach import attach
from tillweave.operators.materialize import stage
from tillweave.operators.surrogate import assign_ids
from tillweave.plans.staging import require_columns, row_order
from tillweave.sources.reference import SourceRule, SourceRules

# Identity types by priority.
TYPE_PRIORITY = ("RECIPE", "NAME_MATCH", "TEMPORARY")


def variants_from_staging(staging: DataFrame) -> DataFrame:
    """Distinct product cells of staging rows."""
    require_columns(
        staging,
        [
            "product_work_key",
            "recipe_number_clean",
            "product_name_selected",
            "product_alternative_names",
            "product_group_final",
            "product_code_clean",
            "product_code_raw",
        ],
        "dim_product staging input",
    )
    order = F.struct(*(row_order(staging) or ["product_group_final", "product_code_raw"]))
    return (
        staging.groupBy(
            "product_work_key",
            "recipe_number_clean",
            "product_code_raw",
            "product_code_clean",
            "product_group_final",
            "product_name_selected",
            "product_alternative_names",
        )
        .agg(F.count("*").alias("n_rows"), F.min(order).alias("first_row"))
        .withColumn("alternative_names", text.split_names(F.col("product_alternative_names")))
        .drop("product_alternative_names")
    )


def code_cells(observations: DataFrame) -> DataFrame:
    """Observations without their files and names: rows, first row by day and first place by file of each key's codes.

    Identity candidates, variants and counts by key are all taken from these; once written, they are far fewer than
    observations where a key shows many names. The first place in a file is a number, whose minimum needs no sort; only
    what is left for each file is sorted for the first file.
    """
    cell = ["product_work_key", "recipe_number_clean", "product_code_raw", "product_code_clean", "product_group_fallback"]
    place = F.col("first_row.place").alias("place")
    files = (
        observations.select(*cell, "report_date", "source_file", "n_rows", place)
        .groupBy(*cell, "report_date", "source_file")
        .agg(F.sum("n_rows").alias("n_rows"), F.min("place").alias("place"))
    )
    first_row = F.struct(F.col("report_date").isNull().alias("undated"), "report_date", "source_file", "place")
    return files.groupBy(*cell).agg(
        F.sum("n_rows").alias("n_rows"),
        F.min(first_row).alias("first_row"),
        F.min(F.struct("source_file", "place")).alias("first_place"),
    )


def variants_from_observations(observations: DataFrame, names: DataFrame) -> DataFrame:
    """The same from staged observations and names."""
    # How observations spread over keys tells enough, and spares the sums of the cells a second time.
    counts = observations.select("product_work_key", F.lit(1).alias("n_rows"))
    return variants_from_cells(code_cells(observations), names, counts, listed=True)


def _listed(names: DataFrame) -> Column:
    return text.split_names(F.col("product_alternative_names")).alias("alternative_names")


def variants_from_cells(
    cells: DataFrame, names: DataFrame, counts: DataFrame | None = None, *, listed: bool = False
) -> DataFrame:
    """The same from ``code_cells``, with all names of a key only if ``listed``; ``counts`` are those of ``attach``."""
    cells = cells.drop("first_row").withColumnRenamed("first_place", "first_row")
    lookup = names.select(
        "product_work_key",
        "product_name_selected",
        "product_canonical_group",
        *([_listed(names)] if listed else []),
    )
    return (
        attach(cells, lookup, "product_work_key", unique=True, counts=counts)
        .withColumn("product_group_final", F.coalesce("product_canonical_group", "product_group_fallback"))
        .drop("product_canonical_group", "product_group_fallback")
    )


def _any_contains(texts: list[Column], patterns: tuple[str, ...]) -> Column:
    tests = [F.contains(F.upper(column), F.lit(pattern.upper())) for column in texts for pattern in patterns]
    return reduce(or_, [F.coalesce(test, F.lit(False)) for test in tests], F.lit(False))


def _rule_conditions(rule: SourceRule) -> list[tuple[Column, bool, bool]]:
    """Per-variant tests of a rule, with the value that "any variant passes" must have, and whether they read names only."""
    codes = [text.strip(F.col("product_code_raw")), text.strip(F.col("product_code_clean"))]
    names = F.array_compact(
        F.concat(F.array("product_name_selected"), F.coalesce("alternative_names", F.array().cast("array<string>")))
    )
    tests: list[tuple[Column, bool, bool]] = []
    if rule.has_recipe_number is not None:
        tests.append((F.col("recipe_number_clean").isNotNull(), rule.has_recipe_number, False))
    if rule.product_code_contains is not None:
        tests.append((_any_contains(codes, rule.product_code_contains), True, False))
    if rule.product_name_in is not None:
        wanted = [name.strip().lower() for name in rule.product_name_in]
        tests.append((F.exists(names, lambda name: F.lower(text.strip(name)).isin(wanted)), True, True))
    if rule.product_name_regex is not None:
        patterns = [f"(?iuU){pattern}" for pattern in rule.product_name_regex]
        tests.append(
            (
                F.exists(
                    names,
                    lambda name: reduce(or_, [name.rlike(p) for p in patterns], F.lit(False)),
                ),
                True,
                True,
            )
        )
    if rule.product_group_in is not None:
        groups = [group.strip() for group in rule.product_group_in]
        group = text.strip(F.col("product_group_final"))
        tests.append((F.coalesce(group.isin(groups), F.lit(False)), True, False))
    return tests


def source_rule_flags(rules: SourceRules) -> tuple[list[Column], list[Column], Column]:
    """RULE-1, RULE-2: aggregate columns for all conditions, those on names apart, and the source computed from them.

    Rules apply in the order (priority, name); the first one whose conditions all hold gives the source.
    """
    flags: list[Column] = []
    name_flags: list[Column] = []
    choices: list[Column] = []
    for at, rule in enumerate(sorted(rules.rules, key=lambda r: (r.priority, r.rule_name))):
        holds = F.lit(True)
        for number, (test, wanted, of_names) in enumerate(_rule_conditions(rule)):
            name = f"_rule_{at}_{number}"
            (name_flags if of_names else flags).append(F.bool_or(test).alias(name))
            holds = and_(holds, F.col(name) == wanted)
        choices.append(F.when(holds, rule.source))
    return flags, name_flags, F.coalesce(*choices, F.lit(rules.default_source))


def most_frequent_group(variants: DataFrame) -> DataFrame:
    """AGG-7: most frequent group per product, the earlier one on a tie; with the number of groups."""
    counted = (
        variants.where("product_group_final IS NOT NULL")
        .groupBy("product_business_key", "product_group_final")
        .agg(F.sum("n_rows").alias("n"), F.min("first_row").alias("first_row"))
    )
    return counted.groupBy("product_business_key").agg(
        F.min_by("product_group_final", F.struct(-F.col("n"), "first_row")).alias("product_type"),
        F.count("*").alias("n_groups"),
    )


def all_names(variants: DataFrame) -> DataFrame:
    """AGG-8: all names of a product, in order."""
    names = F.concat(
        F.array(text.strip(F.col("product_name_selected"))),
        F.coalesce("alternative_names", F.array().cast("array<string>")),
    )
    distinct = (
        variants.select("product_business_key", F.explode(names).alias("name"))
        .where("name <> ''")
        .distinct()
    )
    joined = text.join_names(F.array_sort(F.collect_list("name")))
    return distinct.groupBy("product_business_key").agg(joined.alias("product_alternative_names"))


def product_attributes(variants: DataFrame, rules: SourceRules, named: DataFrame | None = None) -> DataFrame:
    """AGG-4..8, RULE-1, STR-11: one row per business key. ``variants`` carry their identity.

    ``named`` has the names of each work key once, with its business key; else every variant carries those of its key.
    """
    flags, name_flags, source = source_rule_flags(rules)
    rank = F.array_position(F.array(*(F.lit(kind) for kind in TYPE_PRIORITY)), F.col("product_identity_type"))
    name = text.strip(F.col("product_name_selected"))
    recipe = F.col("recipe_number_clean")
    longest = F.min(F.when(name != "", F.struct((-F.length(name)).alias("n"), name.alias("name"))))
    first_recipe = F.min(
        F.when(recipe.isNotNull(), F.struct(F.col("first_row"), recipe.alias("recipe")))
    )
    of_codes = [F.min(rank).cast("int").alias("rank"), first_recipe["recipe"].alias("recipe_number"), *flags]
    of_names = [longest["name"].alias("product_name"), *name_flags]
    if named is None:
        core = variants.groupBy("product_business_key").agg(*of_codes, *of_names)
    else:
        shown = named.groupBy("product_business_key").agg(*of_names)
        core = variants.groupBy("product_business_key").agg(*of_codes).join(shown, "product_business_key", "left")
    return (
        core.join(most_frequent_group(variants), "product_business_key", "left")
        .join(all_names(variants if named is None else named), "product_business_key", "left")
        .select(
            "product_business_key",
            F.element_at(F.array(*(F.lit(kind) for kind in TYPE_PRIORITY)), F.col("rank")).alias(
                "product_identity_type"
            ),
            (F.col("rank") == 1).alias("is_historical_stable"),
            "recipe_number",
            "product_name",
            text.normalized_name(F.col("product_name")).alias("normalized_product_name"),
            "product_type",
            source.alias("source"),
            "product_alternative_names",
        )
    )


def dim_product_from_variants(
    variants: DataFrame,
    identity: DataFrame,
    rules: SourceRules,
    *,
    names: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``names`` of all work keys spare their tests on every variant; ``counts`` are those of ``attach``."""
    keyed = attach(
        variants,
        identity.select("product_work_key", "product_business_key", "product_identity_type"),
        "product_work_key",
        unique=True,
        counts=counts,
    )
    named = None
    if names is not None:
        owners = identity.select("product_work_key", "product_business_key")
        named = names.select("product_work_key", "product_name_selected", _listed(names))
        named = stage(attach(named, owners, "product_work_key", unique=True), "product-names")
    products = stage(product_attributes(stage(keyed, "product-variants"), rules, named), "products")
    return assign_ids(products, "product_id", [F.col("product_business_key")])


def build_dim_product(staging: DataFrame, identity: DataFrame, rules: SourceRules) -> DataFrame:
    """AGG-9: the product dimension from staging rows and their identity."""
    require_columns(
        identity,
        ["product_work_key", "product_business_key", "product_identity_type"],
        "dim_product identity input",
    )
    return dim_product_from_variants(variants_from_staging(staging), identity, rules)
