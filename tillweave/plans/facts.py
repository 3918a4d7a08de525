"""Facts (RSH, FLT, JN-3..8, AGG-10..13, CASE-2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions.numbers import measure
from tillweave.functions.text import quoted
from tillweave.operators.attach import BOUNDS, JoinBounds, attach, fits_broadcast, one_per_key
from tillweave.operators.materialize import stage
from tillweave.plans.costs import daily_costs_of, unit_costs_as_of
from tillweave.plans.staging import require_columns
from tillweave.vocabulary import GROSS, RECEIPT_COST, RECEIVED, UNIT_COST


Seen = Callable[[DataFrame], DataFrame]


def as_it_is(rows: DataFrame) -> DataFrame:
    return rows


def product_keys(identity: DataFrame, dim_product: DataFrame) -> DataFrame:
    """JN-3 and JN-4 in one lookup, written once for all facts: work key to product id."""
    require_columns(identity, ["product_work_key", "product_business_key"], "product identity")
    require_columns(dim_product, ["product_business_key", "product_id"], "dim_product")
    keys = one_per_key(identity.select("product_work_key", "product_business_key"), ["product_work_key"])
    ids = dim_product.select("product_business_key", "product_id")
    found = attach(keys, ids, "product_business_key").select("product_work_key", "product_id")
    return stage(found, "product-keys")


def spot_keys(dim_spot: DataFrame) -> DataFrame:
    require_columns(dim_spot, ["spot_id_raw", "spot_id"], "dim_spot")
    return dim_spot.select("spot_id_raw", "spot_id")


def resolve_rows(
    rows: DataFrame,
    keys: DataFrame,
    dim_spot: DataFrame,
    columns: list[str],
    bounds: JoinBounds = BOUNDS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """JN-3..5 once for all facts: staging rows with ``spot_id`` and ``product_id`` and the named columns only.

    ``counts`` (product_work_key, n_rows), as the observations have them, tells which keys are joined with salts.
    """
    names = ["report_date", "spot_id_raw", "product_work_key", "is_heated"]
    narrow = rows.select(*names, *(quoted(name) for name in columns))
    return _located(narrow, dim_spot, keys, bounds, counts).drop("spot_id_raw", "product_work_key")


def _located(
    rows: DataFrame, dim_spot: DataFrame, keys: DataFrame | None, bounds: JoinBounds, counts: DataFrame | None = None
) -> DataFrame:
    """Attach the ids that the rows don't have yet."""
    if "spot_id" not in rows.columns:
        rows = attach(rows, spot_keys(dim_spot), "spot_id_raw", bounds=bounds)
    if "product_id" not in rows.columns:
        rows = attach(rows, keys, "product_work_key", unique=True, bounds=bounds, counts=counts)
    return rows


def _place(staging: DataFrame) -> list[str]:
    """Day, spot and product of staging rows, by id where the rows are resolved already."""
    spot = "spot_id" if "spot_id" in staging.columns else "spot_id_raw"
    product = "product_id" if "product_id" in staging.columns else "product_work_key"
    return ["report_date", spot, product]


def _keys_for(
    staging: DataFrame, identity: DataFrame | None, dim_product: DataFrame | None, keys: DataFrame | None
) -> DataFrame | None:
    return product_keys(identity, dim_product) if keys is None and "product_id" not in staging.columns else keys


def present_columns(df: DataFrame, dim: DataFrame, column: str) -> list[str]:
    """PRJ-4: values of ``dim[column]`` that are columns of ``df``, in the order of the dimension."""
    id_column = dim.columns[0]
    found = (
        dim.where(F.col(column).isin(df.columns)).orderBy(id_column).select(column).collect()
    )
    return list(dict.fromkeys(row[0] for row in found))


def unpivot_measures(df: DataFrame, ids: list[str], columns: list[str], variable: str) -> DataFrame:
    """RSH-1, RSH-2, FLT-1: one row per non-zero measure."""
    numbers = [quoted(name).cast("double").alias(name) for name in columns]
    wide = df.select(*(quoted(name) for name in ids), *numbers)
    long = wide.unpivot([quoted(name) for name in ids], [quoted(name) for name in columns], variable, "quantity")
    return long.where((F.col("quantity") != 0) & ~F.isnan("quantity"))


def _reduced(
    rows: DataFrame,
    keys: DataFrame | None,
    grain: list[str],
    sums: list[str],
    bounds: JoinBounds,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Sum ``rows`` on their own keys before a shuffled join; rows that need none stay as they are.

    With ``counts`` hot keys are salted, and rows, which hardly ever share day, spot and product, go to the join at once.
    """
    if "product_id" in rows.columns or counts is not None or fits_broadcast(keys, bounds):
        return rows
    return rows.groupBy(*grain).agg(*(F.sum(name).alias(name) for name in sums))


def build_fact_sales_quantity(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    dim_sale_type: DataFrame,
    dim_spot: DataFrame,
    *,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
    seen: Seen = as_it_is,
) -> DataFrame:
    """JN-3..6, AGG-10: quantity per date, spot, product, sale type and heating.

    ``seen`` is put around the rows whose ``quantity`` is summed, as ``quality.Watch.before``. ``counts`` of this and
    the other facts are those of ``resolve_rows``.
    """
    base = [*_place(staging), "is_heated"]
    require_columns(staging, base, "fact_sales_quantity staging")
    columns = present_columns(staging, dim_sale_type, "source_column")
    if not columns:
        raise QualityError("staging has no sales quantity column")
    long = unpivot_measures(staging, base, columns, "source_column").withColumn(
        "quantity", measure(F.col("quantity"))
    )
    long = seen(long)
    keys = _keys_for(staging, identity, dim_product, keys)
    long = _reduced(long, keys, [*base, "source_column"], ["quantity"], bounds, counts)
    # Several codes may share a column; its rows go to the lowest id.
    types = dim_sale_type.select("source_column", "sale_type_id")
    fact = attach(long, types, "source_column", bounds=bounds)
    fact = _located(fact, dim_spot, keys, bounds, counts)
    return (
        fact.groupBy(F.col("report_date").alias("date"), "spot_id", "product_id", "sale_type_id", "is_heated")
        .agg(F.sum("quantity").cast("double").alias("quantity"))
    )


def build_fact_sales_gross(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    dim_spot: DataFrame,
    *,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
    seen: Seen = as_it_is,
) -> DataFrame:
    """FLT-2, JN-3..5, AGG-11: gross amount per date, spot, product and heating."""
    base = [*_place(staging), "is_heated"]
    require_columns(staging, [*base, GROSS], "fact_sales_gross staging")
    amount = quoted(GROSS).cast("double")
    rows = (
        staging.select(*base, amount.alias("amount"))
        .where((F.col("amount") != 0) & ~F.isnan("amount"))
        .withColumn("amount", measure(F.col("amount")))
    )
    rows = seen(rows)
    keys = _keys_for(staging, identity, dim_product, keys)
    rows = _reduced(rows, keys, base, ["amount"], bounds, counts)
    fact = _located(rows, dim_spot, keys, bounds, counts)
    return fact.groupBy(F.col("report_date").alias("date"), "spot_id", "product_id", "is_heated").agg(
        F.sum("amount").cast("double").alias("amount")
    )


def receipt_costs(staging: DataFrame, received: str = RECEIVED) -> DataFrame:
    """FLT-3: unit costs seen on receipts."""
    product = _place(staging)[2]
    require_columns(staging, ["report_date", product, received, UNIT_COST], "fact_productcost staging")
    cost = quoted(UNIT_COST).cast("double")
    priced = staging.where((quoted(received).cast("double") > 0) & cost.isNotNull() & ~F.isnan(cost))
    return priced.select("report_date", product, cost.alias("productcost"))


def costs_by_product(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    *,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
) -> DataFrame:
    """Unit costs seen on receipts with their product: ``date, product_id, productcost``."""
    keys = _keys_for(staging, identity, dim_product, keys)
    seen = receipt_costs(staging)
    if "product_id" not in seen.columns:
        seen = seen if counts is not None or fits_broadcast(keys, bounds) else seen.distinct()
        seen = attach(seen, keys, "product_work_key", unique=True, bounds=bounds, counts=counts)
    return seen.select(F.col("report_date").alias("date"), "product_id", "productcost")


def build_fact_productcost(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    *,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """AGG-13: the highest unit cost per date and product."""
    return highest_costs(costs_by_product(staging, identity, dim_product, keys=keys, counts=counts))


def highest_costs(costs: DataFrame) -> DataFrame:
    return costs.groupBy("date", "product_id").agg(F.max("productcost").alias("productcost"))


def productcost_conflicts(
    staging: DataFrame,
    identity: DataFrame,
    dim_product: DataFrame,
    *,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """DQ-10: dates and products with several unit costs."""
    return conflicting_costs(costs_by_product(staging, identity, dim_product, keys=keys, counts=counts).distinct())


def conflicting_costs(costs: DataFrame) -> DataFrame:
    """Of distinct costs by day and product."""
    return (
        costs.groupBy("date", "product_id")
        .agg(F.count("*").alias("productcost_unique_count"))
        .where("productcost_unique_count > 1")
    )


def movement_base(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    dim_spot: DataFrame,
    dim_movement_type: DataFrame,
    *,
    receipt_column: str = RECEIVED,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
    seen: Seen = as_it_is,
) -> DataFrame:
    """RSH-2, FLT-1, JN-3..5, JN-7: movements at their final grain, not yet valued.

    The cost of a movement is linear in its quantity, so the sums needed for it are taken before valuation:
    the receipt cost that the source gives, and the quantity that must be valued by unit cost.
    """
    place = _place(staging)
    base = [*place, RECEIPT_COST]
    require_columns(staging, base, "fact_inventory_movement staging")
    columns = present_columns(staging, dim_movement_type, "movement_type_column")
    if not columns:
        raise QualityError("staging has no inventory movement column")
    long = unpivot_measures(staging, base, columns, "movement_type_column")
    given = quoted(RECEIPT_COST).cast("double")
    is_receipt = F.col("movement_type_column") == receipt_column
    direct = F.when(is_receipt & given.isNotNull() & ~F.isnan(given), given)
    long = long.select(
        *place,
        "movement_type_column",
        measure(F.col("quantity")).alias("quantity"),
        measure(direct).alias("direct_cost"),
        measure(F.when(direct.isNull(), F.col("quantity"))).alias("open_quantity"),
        F.when(direct.isNull(), 1).otherwise(0).cast("long").alias("open_rows"),
    )
    long = seen(long)
    sums = ["quantity", "direct_cost", "open_quantity", "open_rows"]
    keys = _keys_for(staging, identity, dim_product, keys)
    long = _reduced(long, keys, [*place, "movement_type_column"], sums, bounds, counts)
    types = dim_movement_type.select("movement_type_column", "movement_type_id")
    fact = attach(long, types, "movement_type_column", bounds=bounds)
    fact = _located(fact, dim_spot, keys, bounds, counts)
    is_receipt = (F.col("movement_type_column") == receipt_column).alias("is_receipt")
    return fact.groupBy(
        F.col("report_date").alias("date"), "spot_id", "product_id", "movement_type_id", is_receipt
    ).agg(*(F.sum(name).alias(name) for name in sums))


def value_movements(base: DataFrame, unit_costs: DataFrame) -> DataFrame:
    """CASE-2: cost = given receipt cost + open quantity × unit cost, 0 where neither is known."""
    costs = unit_costs.select("date", "product_id", "productcost")
    valued = base.join(costs, ["date", "product_id"], "left")
    opened = measure(F.col("open_quantity").cast("double") * F.col("productcost"))
    zero = measure(F.lit(0))
    cost = F.coalesce("direct_cost", zero) + F.coalesce(opened, zero)
    return valued.withColumn("cost", cost.cast("double"))


def build_fact_inventory_movement(
    staging: DataFrame,
    identity: DataFrame | None,
    dim_product: DataFrame | None,
    dim_spot: DataFrame,
    dim_movement_type: DataFrame,
    costs: DataFrame,
    *,
    as_of: bool = False,
    receipt_column: str = RECEIVED,
    keys: DataFrame | None = None,
    counts: DataFrame | None = None,
    bounds: JoinBounds = BOUNDS,
) -> DataFrame:
    """JN-8, CASE-2, AGG-12: quantity and cost per date, spot, product and movement type.

    ``costs`` is the daily cost table, or with ``as_of=True`` the cost events themselves, which gives the same
    result without building the daily table.
    """
    base = movement_base(
        staging,
        identity,
        dim_product,
        dim_spot,
        dim_movement_type,
        receipt_column=receipt_column,
        keys=keys,
        counts=counts,
        bounds=bounds,
    )
    base = stage(base, "movements")
    unit_costs = unit_costs_as_of(base, costs) if as_of else daily_costs_of(base, costs).hint("shuffle_merge")
    return value_movements(base, unit_costs).select(
        "date",
        "spot_id",
        "product_id",
        "movement_type_id",
        F.col("quantity").cast("double").alias("quantity"),
        "cost",
    )


def movement_cost_issues(valued: DataFrame, sample: int = 20) -> DataFrame:
    """DQ-10, LIM-1: how many movement rows had to be valued without the cost they should have had, and which.

    ``detail`` lists the first days, products and movement types of each kind. Keys are summed first; a task then keeps
    the first ``sample`` of each kind, so what meets for a kind are ``sample`` rows of each task.
    """
    missing = F.col("productcost").isNull()
    issue = (
        F.when(F.col("is_receipt") & ~missing, "receipt_cost_from_unit_cost")
        .when(F.col("is_receipt"), "receipt_without_cost")
        .when(missing, "movement_without_unit_cost")
    )
    key = ["date", "product_id", "movement_type_id"]
    found = valued.where("open_rows > 0").withColumn("issue", issue).where("issue IS NOT NULL")
    found = stage(found.groupBy("issue", *key).agg(F.sum("open_rows").alias("n_rows")), "open-movements")
    first = F.row_number().over(Window.partitionBy("issue").orderBy(*key))
    listed = found.withColumn("place", first).where(F.col("place") <= sample)
    text = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    listed = listed.groupBy("issue").agg(F.array_sort(F.collect_list(F.struct("place", text.alias("key")))).alias("keys"))
    totals = found.groupBy("issue").agg(F.sum("n_rows").alias("n_rows"))
    return totals.join(listed, "issue").select("issue", "n_rows", F.array_join("keys.key", ", ").alias("detail"))
