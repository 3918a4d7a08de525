"""Product identity without stable ids (AGG-3, WIN-3).

Candidates are taken in the order (first date, recipes first, work key). A recipe names its product itself. Any
other candidate belongs to the product that first showed its selected name inside the same group, or starts a
product of its own. As a product's group never changes, "the product that first showed the name" is the
product of the first candidate with that (group, name), which is a minimum and not a sequential scan:

* ``parent`` of a candidate = first candidate with its (group, selected name); itself for recipes,
* the product of a candidate = the last candidate that is reached over parents.

The chains are followed by pointer doubling on the candidates that are somebody's parent, which are at most as
many as there are (group, name) pairs and recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.functions import text
from tillweave.operators.attach import attach
from tillweave.operators.materialize import stage
from tillweave.plans.staging import require_columns, row_order

IDENTITY_COLUMNS = [
    "product_work_key",
    "product_business_key",
    "product_identity_type",
    "is_historical_stable",
    "identity_match_source",
]


def candidates_from_staging(staging: DataFrame) -> DataFrame:
    """AGG-3 from staging rows: the earliest row of each work key."""
    require_columns(
        staging,
        [
            "report_date",
            "product_work_key",
            "recipe_number_clean",
            "product_name_selected",
            "product_alternative_names",
            "product_group_final",
        ],
        "identity input",
    )
    order = F.struct(
        F.col("report_date").isNull(), "report_date", *row_order(staging), "product_group_final"
    )
    kept = F.struct(
        F.col("report_date").alias("first_seen_date"),
        "recipe_number_clean",
        "product_name_selected",
        "product_alternative_names",
        "product_group_final",
    )
    first = staging.groupBy("product_work_key").agg(F.min_by(kept, order).alias("first"))
    return first.select(
        "product_work_key",
        "first.first_seen_date",
        "first.recipe_number_clean",
        "first.product_name_selected",
        text.split_names(F.col("first.product_alternative_names")).alias("alternative_names"),
        "first.product_group_final",
    )


def candidates_from_observations(observations: DataFrame, names: DataFrame) -> DataFrame:
    """AGG-3 from staged observations and names, without touching the rows again."""
    kept = F.struct("recipe_number_clean", "product_group_fallback")
    first = observations.groupBy("product_work_key").agg(
        F.min("first_row").alias("first_row"), F.min_by(kept, "first_row").alias("first")
    )
    joined = first.join(names, "product_work_key", "left")
    return joined.select(
        "product_work_key",
        F.col("first_row.report_date").alias("first_seen_date"),
        "first.recipe_number_clean",
        "product_name_selected",
        text.split_names(F.col("product_alternative_names")).alias("alternative_names"),
        F.coalesce("product_canonical_group", "first.product_group_fallback").alias("product_group_final"),
    )


def _group_key(group: Column) -> Column:
    """Group as a join key under which two missing groups are equal."""
    return F.when(group.isNull(), "-").otherwise(F.concat(F.lit("+"), group))


def resolve_identity(candidates: DataFrame) -> DataFrame:
    """WIN-3 over one row per work key."""
    selected = text.identity_name(F.col("product_name_selected"))
    recipe = F.col("recipe_number_clean")
    nodes = stage(
        candidates.select(
            F.col("product_work_key").alias("node"),
            F.when(recipe.isNotNull(), F.concat(F.lit("RECIPE_"), recipe))
            .otherwise(F.concat(F.lit("TEMP_"), "product_work_key"))
            .alias("own_key"),
            recipe.isNotNull().alias("has_recipe"),
            "first_seen_date",
            _group_key(F.col("product_group_final")).alias("group_key"),
            selected.alias("name"),
            F.array_compact(
                F.array_union(
                    F.array(selected),
                    F.transform(
                        F.coalesce("alternative_names", F.array().cast("array<string>")), text.identity_name
                    ),
                )
            ).alias("names"),
        ),
        "identity-nodes",
    )

    order = F.struct(
        F.col("first_seen_date").isNull().alias("undated"),
        "first_seen_date",
        (~F.col("has_recipe")).alias("no_recipe"),
        "node",
        "own_key",
    )
    owners = (
        nodes.select("group_key", F.explode("names").alias("name"), order.alias("first"))
        .groupBy("group_key", "name")
        .agg(F.min("first").alias("first"))
        .select("group_key", "name", F.col("first.node").alias("owner"), F.col("first.own_key").alias("owner_key"))
    )
    owners = stage(owners, "identity-owners")

    seeking = nodes.select("node", "own_key", "has_recipe", "group_key", "name")
    keeps_itself = F.col("has_recipe") | F.col("owner").isNull()
    links = stage(
        attach(seeking, owners, ["group_key", "name"], unique=True).select(
            "node",
            "has_recipe",
            F.when(keeps_itself, F.col("node")).otherwise(F.col("owner")).alias("parent"),
            F.when(keeps_itself, F.col("own_key")).otherwise(F.col("owner_key")).alias("parent_key"),
        ),
        "identity-links",
    )
    roots = _follow(links)
    resolved = attach(links, roots.withColumnRenamed("node", "parent"), "parent", unique=True)

    is_root = F.col("root") == F.col("node")
    kind = F.when(F.col("has_recipe"), "RECIPE").when(is_root, "TEMPORARY").otherwise("NAME_MATCH")
    return (
        resolved.withColumn("product_identity_type", kind)
        .withColumns(
            {
                "is_historical_stable": F.col("product_identity_type") == "RECIPE",
                "identity_match_source": F.when(
                    F.col("product_identity_type") == "TEMPORARY", "TEMP"
                ).otherwise(F.col("product_identity_type")),
            }
        )
        .select(
            F.col("node").alias("product_work_key"),
            F.col("root_key").alias("product_business_key"),
            "product_identity_type",
            "is_historical_stable",
            "identity_match_source",
        )
    )


def _follow(links: DataFrame) -> DataFrame:
    """End of the chain of each node that is a parent: ``(node, root, root_key)``.

    A round doubles the distance that a pointer spans, so chains of length n need log2(n) rounds.
    """
    parents = links.select(F.col("parent").alias("node")).distinct()
    pointers = stage(
        links.join(parents, "node", "left_semi").select(
            "node", F.col("parent").alias("root"), F.col("parent_key").alias("root_key")
        ),
        "identity-pointers",
    )
    while True:
        following = pointers.select(
            F.col("node").alias("root"), F.col("root").alias("next"), F.col("root_key").alias("next_key")
        )
        moved = stage(
            attach(pointers, following, "root", unique=True).select(
                "node",
                F.col("next").alias("root"),
                F.col("next_key").alias("root_key"),
                (F.col("next") != F.col("root")).alias("moved"),
            ),
            "identity-pointers",
        )
        pointers = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return pointers


def build_product_identity(staging: DataFrame) -> DataFrame:
    """The identity table from staging rows."""
    return resolve_identity(candidates_from_staging(staging))


def group_conflicts(candidates: DataFrame) -> DataFrame:
    """DQ-9: names that occur in several groups and therefore stay separate products."""
    named = candidates.select(
        text.identity_name(F.col("product_name_selected")).alias("name"), "product_group_final"
    ).where("name IS NOT NULL")
    distinct = named.distinct()
    groups = F.count("*").alias("n_groups")
    joined = F.array_join(F.array_sort(F.collect_list("product_group_final")), " | ").alias("groups")
    return distinct.groupBy("name").agg(groups, joined).where("n_groups > 1")
