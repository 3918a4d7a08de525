"""The full run: raw rows to nine checked model tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.errors import QualityError
from tillweave.functions.text import quoted
from tillweave.operators.attach import attach
from tillweave.operators.materialize import compiled, owned_scratch, stage, tidy
from tillweave.plans import costs, dimensions, facts, identity, products, quality, staging
from tillweave.sources.reference import CalendarNames, SaleTypes, SourceRules
from tillweave.sources.sinks import publish, read_raw, snapshot, write_in_order, write_raw, write_table
from tillweave.vocabulary import GROSS, LINEAGE, RECEIPT_COST, UNIT_COST

SNAPSHOTS = frozenset(
    {"staging", "observations", "product_names", "product_candidates", "product_identity", "productcost_daily_lookup"}
)


#: Facts, whose grains are their groups and so can't repeat: what is summed, what is never null, what is never negative.
WATCHED = {
    "fact_sales_quantity": (
        {"quantity": "quantity"},
        ["date", "spot_id", "product_id", "sale_type_id", "is_heated", "quantity"],
        ["quantity"],
    ),
    "fact_sales_gross": ({"amount": "amount"}, ["date", "spot_id", "product_id", "is_heated", "amount"], ["amount"]),
    "fact_productcost": ({}, ["date", "product_id", "productcost"], ["productcost"]),
    "fact_inventory_movement": (
        {"quantity": "quantity"},
        ["date", "spot_id", "product_id", "movement_type_id", "quantity", "cost"],
        ["quantity", "cost"],
    ),
}


@dataclass(frozen=True)
class Settings:
    spots: DataFrame
    movement_types: DataFrame
    sale_types: SaleTypes
    source_rules: SourceRules
    corrections: DataFrame
    calendar_names: CalendarNames


@dataclass(frozen=True)
class ProductModel:
    """Tables keyed by work key or product that all facts share, each written once."""

    observations: DataFrame
    names: DataFrame
    candidates: DataFrame
    identity: DataFrame
    dim_product: DataFrame
    keys: DataFrame
    cells: DataFrame
    counts: DataFrame  # rows by work key, which tell joins by work key which keys are hot
    cell_counts: DataFrame  # the same of cells

    def keyed_variants(self) -> DataFrame:
        variants = products.variants_from_cells(self.cells, self.names, self.cell_counts)
        return attach(variants, self.identity, "product_work_key", unique=True, counts=self.cell_counts)


def build_product_model(rows: DataFrame, corrections: DataFrame, rules: SourceRules) -> ProductModel:
    """Names, identity and product dimension from one pass over the rows."""
    observations = staging.staged_observations(rows)
    names = stage(staging.product_names(observations, corrections), "names")
    cells = stage(products.code_cells(observations), "cells")
    sums = cells.groupBy("product_work_key").agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_cells"))
    sums = stage(sums, "counts")
    counts = sums.select("product_work_key", "n_rows")
    cell_counts = sums.select("product_work_key", F.col("n_cells").alias("n_rows"))
    candidates = stage(identity.candidates_from_observations(cells, names), "candidates")
    resolved = stage(identity.resolve_identity(candidates), "identity")
    variants = products.variants_from_cells(cells, names, cell_counts)
    dim_product = stage(products.dim_product_from_variants(variants, resolved, rules, names=names, counts=cell_counts), "dim-product")
    keys = facts.product_keys(resolved, dim_product)
    return ProductModel(observations, names, candidates, resolved, dim_product, keys, cells, counts, cell_counts)


def model_columns(rows: DataFrame, measures: list[str]) -> DataFrame:
    """The columns of prepared rows that product model and facts read. What the others are made of is then not computed."""
    names = ["report_date", "spot_id_raw", "product_work_key", "is_heated", *staging.CELLS, *staging.row_order(rows)]
    return rows.select(*(quoted(name) for name in dict.fromkeys([*names, *measures])))


def stage_prepared(rows: DataFrame) -> DataFrame:
    """Prepared rows, written once without their raw product cells, which repeat other columns and are read from those."""
    return stage(rows.drop(*staging.CELLS), "prepared").transform(staging.with_product_cells).select(*(quoted(name) for name in rows.columns))


def validate_raw(raw: DataFrame) -> DataFrame:
    """DQ-1, DQ-3, DQ-8 on the raw layer."""
    staging.require_columns(raw, list(LINEAGE), "raw layer")
    return quality.table_issues(raw, "raw", [name for name in LINEAGE if name != "source_sheet_clean"], [])


def run_warehouse(
    raw: DataFrame,
    settings: Settings,
    folder: str,
    *,
    file_format: str = "parquet",
    snapshot_folder: str | None = None,
    snapshots: frozenset[str] = SNAPSHOTS,
) -> dict[str, DataFrame]:
    """Write the raw layer, the model tables and ``dq_issues`` below ``folder``; return them all by name.

    Tables are built aside and checked there. A broken constraint of severity ``error`` ends the run with
    ``QualityError`` before any model table is published; ``dq_issues`` is written in full either way. The model tables
    are published together, as the next version that ``sinks.read_published`` finds. What was written aside is deleted
    at the end.
    """
    spark = raw.sparkSession
    issues: list[DataFrame] = []

    def publish_issues() -> DataFrame:
        return write_table(quality.unite(*issues), f"{folder}/dq_issues")

    def check(*found: DataFrame) -> None:
        """Keep the issues of some checks, and stop if one of them is an error."""
        issues.append(stage(quality.unite(*found), "issues"))
        try:
            quality.raise_on_errors(issues[-1])
        except QualityError:
            publish_issues()
            raise

    # Settings of writes are made once, as some run side by side. What still runs when a check fails ends before the scratch goes.
    with owned_scratch(spark), compiled(spark), tidy(spark), ThreadPoolExecutor(2) as pool:

        def beside(work: Callable[[], DataFrame | None]) -> Future:
            return pool.submit(copy_context().run, inheritable_thread_target(spark)(work))

        check(validate_raw(raw))
        raw = staging.normalize_columns(raw)
        write_raw(raw, f"{folder}/raw")
        raw = read_raw(raw, f"{folder}/raw")
        tables, kept = _model_tables(raw, settings, check, snapshot_folder, snapshots, beside)
        out = publish(tables, folder, file_format)
        if file_format == "csv":  # a CSV file has no types: what is returned is the table as it was built
            out = {name: write_table(df, f"{folder}/typed/{name}") for name, df in tables.items()}
        out["dq_issues"] = publish_issues()
        out["product_identity"] = write_table(kept, f"{folder}/product_identity")
    out["raw"] = raw
    return out


def _model_tables(
    raw: DataFrame,
    settings: Settings,
    check: Callable[..., None],
    snapshot_folder: str | None,
    snapshots: frozenset[str],
    beside: Callable[[Callable[[], DataFrame | None]], Future],
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The model tables, built aside and checked, and the product identity.

    ``beside`` begins work that nothing waits for until the last checks: a job's last tasks leave cores to it.
    """

    def keep(name: str, df: DataFrame) -> None:
        snapshot(df, name, snapshot_folder, snapshots)

    spots = settings.spots
    dim_spot = stage(dimensions.build_dim_spot(spots), "dim-spot")
    dim_movement_type = stage(dimensions.build_dim_movement_type(settings.movement_types), "dim-movement-type")
    check(
        quality.table_issues(dim_spot, "dim_spot", ["spot_id_raw"], []),
        quality.duplicate_issues(dim_spot, ["spot_id_raw"], "dim_spot"),
        quality.empty_issue(dim_movement_type, "dim_movement_type"),
        quality.movement_type_issues(dim_movement_type),
    )

    # The raw rows are parsed once. Everything below reads columns of the prepared table.
    rows = stage_prepared(staging.prepare_rows(raw, None, settings.sale_types))
    dim_sale_type = stage(dimensions.build_dim_sale_type(rows, settings.sale_types), "dim-sale-type")
    model = build_product_model(rows, settings.corrections, settings.source_rules)

    def keep_model() -> None:
        keep("observations", model.observations)
        keep("product_names", model.names)
        keep("product_candidates", model.candidates)
        keep("product_identity", model.identity)

    kept = [beside(keep_model)]
    keyed = model.keyed_variants()
    known_spots = dim_spot.select(F.col("spot_id_raw").cast("string").alias("spot_id_raw"))
    asked_spots = rows.select(F.coalesce(staging.spot_number(rows).cast("string"), F.col("spot_id_raw").cast("string")).alias("spot_id_raw"))
    check(
        quality.invalid_issues(rows, "report_date_raw", "report_date", "staging"),
        quality.unmatched_issues(asked_spots, known_spots, "spot_id_raw", "staging"),
        quality.unmatched_issues(model.observations, model.keys, "product_work_key", "staging"),
        quality.control_mismatch_issues(rows),
        quality.group_conflict_issues(identity.group_conflicts(model.candidates)),
        quality.duplicate_issues(model.identity, ["product_work_key"], "product_identity"),
        quality.table_issues(
            model.dim_product, "dim_product", ["product_id", "product_business_key", "product_name"], []
        ),
        quality.duplicate_issues(model.dim_product, ["product_business_key"], "dim_product"),
        quality.product_type_issues(products.most_frequent_group(keyed)),
    )

    def keep_staging() -> DataFrame:
        named = staging.with_names(rows, model.names, model.counts)
        keep("staging", staging.with_spots(named, spots, rows, rows.columns[-1]))
        written = raw.sparkSession.read.parquet(f"{snapshot_folder}/staging")
        return quality.short_name_issues(quality.short_names(written))

    found = []
    if snapshot_folder is not None and "staging" in snapshots:
        found.append(beside(keep_staging))

    dim_date = stage(dimensions.build_dim_date(model.observations, settings.calendar_names), "dim-date")
    check(quality.table_issues(dim_date, "dim_date", ["month_name", "day_name"], []))

    # Keys are looked up once, in one shuffle at most, for all facts.
    sale_columns = facts.present_columns(rows, dim_sale_type, "source_column")
    move_columns = facts.present_columns(rows, dim_movement_type, "movement_type_column")
    measures = list(dict.fromkeys([*sale_columns, *move_columns, GROSS, UNIT_COST, RECEIPT_COST]))
    located = stage(facts.resolve_rows(rows, model.keys, dim_spot, measures, counts=model.counts), "located")
    shared = (located, None, None)
    watches = {name: quality.Watch(name, *watched) for name, watched in WATCHED.items()}
    sold, earned, priced, moved = watches.values()
    quantity = stage(sold.after(facts.build_fact_sales_quantity(*shared, dim_sale_type, dim_spot, seen=sold.before)), "fact")
    gross = stage(earned.after(facts.build_fact_sales_gross(*shared, dim_spot, seen=earned.before)), "fact")
    seen = stage(facts.costs_by_product(*shared).distinct(), "costs")
    cost = stage(priced.after(facts.highest_costs(seen)), "fact")

    def keep_daily() -> DataFrame:
        daily = costs.daily_by_month(cost, dim_date)
        path = f"{snapshot_folder}/productcost_daily_lookup"
        write_in_order(daily, path, ["product_id", "date"])
        daily = raw.sparkSession.read.schema(daily.schema).parquet(path)  # the checks need no numbers of rows
        written = quality.unite(
            quality.table_issues(
                daily, "productcost_daily_lookup", ["date", "product_id", "productcost"], ["productcost"], "warning"
            ),
            quality.duplicate_issues(daily, ["date", "product_id"], "productcost_daily_lookup"),
        )
        return stage(written, "issues")

    if snapshot_folder is not None and "productcost_daily_lookup" in snapshots:
        found.append(beside(keep_daily))
    base = stage(facts.movement_base(*shared, dim_spot, dim_movement_type, seen=moved.before), "movements")
    valued = stage(moved.after(facts.value_movements(base, costs.unit_costs_as_of(base, cost))), "valued")
    movement = valued.select(
        "date",
        "spot_id",
        "product_id",
        "movement_type_id",
        F.col("quantity").cast("double").alias("quantity"),
        "cost",
    )
    tables = {
        "dim_date": dim_date,
        "dim_spot": dim_spot,
        "dim_sale_type": dim_sale_type,
        "dim_movement_type": dim_movement_type,
        "dim_product": model.dim_product,
        "fact_sales_quantity": quantity,
        "fact_sales_gross": gross,
        "fact_productcost": cost,
        "fact_inventory_movement": movement,
    }
    written = dict(zip(watches, (quantity, gross, cost, valued), strict=True))
    checks = [
        *(watch.issues(written[name]) for name, watch in watches.items()),
        quality.cost_conflict_issues(facts.conflicting_costs(seen)),
        quality.missing_cost_issues(valued),
    ]
    for work in kept:
        work.result()
    check(*checks, *(work.result() for work in found))
    return tables, model.identity
