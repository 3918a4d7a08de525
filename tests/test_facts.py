"""Facts, costs and sale types."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tillweave.operators.attach import JoinBounds, attach
from tillweave.operators.materialize import compiled, owned_scratch, stage
from tillweave.operators.surrogate import assign_ids
from tillweave.plans import costs, dimensions, facts, identity, products, staging
from tillweave.queries import report as source
from tillweave.sources.reference import FixedSaleType, GroupedColumn, SaleTypes

SHUFFLED = JoinBounds(broadcast_rows=0)
D = [dt.date(2026, 3, day) for day in range(1, 8)]


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def model(spark, sf):
    rows = stage(source.rows(spark, sf), "rows")
    return rows, source.model(spark, sf), dimensions.build_dim_spot(source.spots(spark, sf))


def test_facts_are_the_same_by_broadcast_by_shuffle_and_from_resolved_rows(spark, model):
    rows, built, spots = model
    types = dimensions.build_dim_sale_type(rows, source.SALE_TYPES)
    moves = dimensions.build_dim_movement_type(source.movement_types(spark))
    shared = (rows, built.identity, built.dim_product)
    measures = [name for name in rows.columns if name in types.toPandas()["source_column"].tolist()]
    measures += ["Przyjęto", "Zwrócono", "Uszkodzenia - Zwrot", "Brutto", "koszt-jednostka", "koszt-przyjęcie"]
    located = facts.resolve_rows(rows, built.keys, spots, measures)
    for make in (
        lambda first, bounds: facts.build_fact_sales_quantity(*first, types, spots, keys=built.keys, bounds=bounds),
        lambda first, bounds: facts.build_fact_sales_gross(*first, spots, keys=built.keys, bounds=bounds),
        lambda first, bounds: facts.costs_by_product(*first, keys=built.keys, bounds=bounds).distinct(),
        lambda first, bounds: facts.movement_base(*first, spots, moves, keys=built.keys, bounds=bounds),
    ):
        small = rows_of(make(shared, JoinBounds()))
        assert small and rows_of(make(shared, SHUFFLED)) == small
        assert rows_of(make((located, None, None), JoinBounds())) == small


def test_two_codes_of_one_column_do_not_double_quantities(spark):
    config = SaleTypes(
        (FixedSaleType("A", "ONE", "One"), FixedSaleType("B", "TWO", "Two")), (GroupedColumn("G", ("A", "B")),), ("Suma",)
    )
    raw = spark.createDataFrame([(D[0], 1, "k", False, 2.0, 3.0)], "report_date date, spot_id_raw long, product_work_key string, is_heated boolean, A double, B double")
    rows = staging.enrich_sales_types(raw, config)
    types = dimensions.build_dim_sale_type(rows, config)
    keys = spark.createDataFrame([("k", 9)], "product_work_key string, product_id int")
    spots = spark.createDataFrame([(1, 4), (1, 5)], "spot_id_raw int, spot_id int")
    fact = facts.build_fact_sales_quantity(rows, None, None, types, spots, keys=keys).collect()
    assert [(r["spot_id"], r["sale_type_id"], r["quantity"]) for r in fact] == [(4, 1, 5.0)]


def test_attach_keeps_the_number_of_rows(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c")], "k int, v string")
    for bounds in (JoinBounds(), SHUFFLED):
        assert rows_of(attach(rows, lookup, "k", bounds=bounds)) == sorted(map(repr, [(1, "a"), (1, "a"), (2, None), (None, None)]))


def test_grouped_sale_columns(spark):
    config = SaleTypes((FixedSaleType("A", "ONE", "One"),), (GroupedColumn("G", ("A", "B")),), ("Suma",))
    both = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 2.0, 9.0)], "A double, B double, Suma double")
    found = staging.enrich_sales_types(both, config).collect()
    assert [(r["G"], r["sales_total_matches_control"]) for r in found] == [(3.0, True), (2.0, False)]
    none = spark.createDataFrame([(5.0,)], "G double")
    row = staging.enrich_sales_types(none, config).first()
    assert (row["G"], row["sales_total_matches_control"]) == (0.0, None)


def test_daily_costs(spark):
    days = spark.createDataFrame([(d,) for d in D], "date date")
    events = spark.createDataFrame([(D[1], 1, 2.0), (D[3], 1, 3.0), (D[6], 2, 9.0), (D[0], 3, None)], "date date, product_id int, productcost double")
    found = costs.build_productcost_daily_lookup(events, days)
    want = [(d, 1, 2.0 if d < D[3] else 3.0) for d in D[1:]] + [(D[6], 2, 9.0)]
    assert rows_of(found.select("date", "product_id", "productcost")) == sorted(map(repr, want))
    asked = spark.createDataFrame([(d, p) for d in D for p in (1, 2, 3)], "date date, product_id int")
    as_of = costs.unit_costs_as_of(asked, events).where("productcost IS NOT NULL")
    assert rows_of(as_of) == sorted(map(repr, want))


def test_movement_costs(spark):
    schema = "report_date date, spot_id int, product_id int, `Przyjęto` double, `Zwrócono` double, `koszt-przyjęcie` double"
    rows = spark.createDataFrame(
        [(D[0], 1, 1, 2.0, None, 7.0), (D[0], 1, 2, 2.0, None, None), (D[0], 1, 3, 2.0, None, None),
         (D[1], 1, 2, None, 3.0, None), (D[1], 1, 3, None, 3.0, None), (D[1], 1, 1, 0.0, None, 5.0)], schema)
    moves = dimensions.build_dim_movement_type(source.movement_types(spark))
    cost = spark.createDataFrame([(D[0], 2, 1.5)], "date date, product_id int, productcost double")
    fact = facts.build_fact_inventory_movement(rows, None, None, None, moves, cost, as_of=True).collect()
    assert sorted((r["date"], r["product_id"], r["quantity"], r["cost"]) for r in fact) == [
        (D[0], 1, 2.0, 7.0), (D[0], 2, 2.0, 3.0), (D[0], 3, 2.0, 0.0), (D[1], 2, 3.0, 4.5), (D[1], 3, 3.0, 0.0)]


def test_calendar_of_a_month(spark):
    days = spark.createDataFrame([(dt.date(2026, 3, 2),), (dt.date(2026, 3, 31),)], "report_date date")
    rows = dimensions.build_dim_date(days, source.CALENDAR).orderBy("date").collect()
    assert len(rows) == 30
    assert tuple(rows[0]) == (dt.date(2026, 3, 2), 2026, 1, 3, "marzec", 10, 2, 1, "poniedziałek", False, "2026-03", "2026-W10")
    assert [r["is_weekend"] for r in rows[:7]] == [False] * 5 + [True, True]


def test_sale_and_movement_types(spark):
    wide = spark.createDataFrame([(1.0, 1.0, 1.0)], "`50%` double, `30%` double, `Sprzedaż` double")
    types = dimensions.build_dim_sale_type(wide, source.SALE_TYPES).orderBy("sale_type_id").collect()
    assert [(r["sale_type_code"], r["source_column"], r["discount_pct"]) for r in types] == [
        ("FULL_PRICE", "Sprzedaż", None), ("TGTG", "Paczki", None), ("DISCOUNT_30", "30%", 30), ("DISCOUNT_50", "50%", 50)]
    moves = dimensions.build_dim_movement_type(source.movement_types(spark)).orderBy("movement_type_id").collect()
    assert [r["movement_type_column"] for r in moves] == ["Przyjęto", "Zwrócono", "Uszkodzenia - Przyjęcie", "Uszkodzenia - Zwrot"]


def test_surrogate_ids_by_ranges(spark):
    frame = spark.range(50).selectExpr("id * 7 % 50 AS v")
    one = assign_ids(frame, "n", [F.col("v")])
    many = assign_ids(frame, "n", [F.col("v")], one_task_rows=0, ranges=5)
    assert rows_of(one) == rows_of(many) == sorted(map(repr, [(i + 1, i) for i in range(50)]))


def test_a_runs_scratch_is_deleted(spark):
    import os

    with owned_scratch(spark) as folder:
        stage(spark.range(3), "x").count()
        assert os.listdir(folder.removeprefix("file://"))
    assert not os.path.exists(folder.removeprefix("file://"))


def test_daily_costs_are_made_by_many_tasks_and_never_broadcast(spark):
    """days exploded from intervals look small to Spark, and few bytes of events would be gathered in one task."""
    days = spark.createDataFrame([(D[0] + dt.timedelta(n),) for n in range(3000)], "date date")
    cost = stage(spark.createDataFrame([(D[0], n, 1.0) for n in range(40)], "date date, product_id int, productcost double"), "cost")
    daily = costs.build_productcost_daily_lookup(cost, days)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert daily.rdd.getNumPartitions() == costs.daily_by_month(cost, days).rdd.getNumPartitions() == tasks > 1
    rows = spark.createDataFrame(
        [(D[2], 1, "k", 2.0, None), (D[3], 1, "k", 3.0, 5.0), (D[3], 2, "other", 1.0, None)],
        "report_date date, spot_id_raw long, product_work_key string, `Przyjęto` double, `koszt-przyjęcie` double",
    )
    keys = spark.createDataFrame([("k", 9)], "product_work_key string, product_id int")
    spots = spark.createDataFrame([(1, 4), (2, 5)], "spot_id_raw int, spot_id int")
    moves = dimensions.build_dim_movement_type(source.movement_types(spark))
    fact = facts.build_fact_inventory_movement(rows, None, None, spots, moves, daily, keys=keys)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[date#\d+, product_id#\d+\]", plan)
    assert not re.search(r"BroadcastHashJoin \[date#\d+, product_id#\d+\]", plan)
    kept = {(r["date"], r["spot_id"]): (r["quantity"], r["cost"]) for r in fact.collect()}
    assert kept == {(D[2], 4): (2.0, 2.0), (D[3], 4): (3.0, 5.0), (D[3], 5): (1.0, 0.0)}


def test_counts_spare_the_sum_and_the_count_before_a_shuffled_join(spark, model):
    """F4 to F19: with the counts at hand, rows are not aggregated once to be counted and again to be joined."""
    rows, built, spots = model
    types = dimensions.build_dim_sale_type(rows, source.SALE_TYPES)
    moves = dimensions.build_dim_movement_type(source.movement_types(spark))
    bounds = JoinBounds(broadcast_rows=0, salt_bytes=0)
    for make in (
        lambda **given: facts.build_fact_sales_quantity(rows, None, None, types, spots, keys=built.keys, **given),
        lambda **given: facts.build_fact_sales_gross(rows, None, None, spots, keys=built.keys, **given),
        lambda **given: facts.costs_by_product(rows, None, None, keys=built.keys, **given).distinct(),
        lambda **given: facts.movement_base(rows, None, None, spots, moves, keys=built.keys, **given),
    ):
        with_counts, without = make(counts=built.counts, bounds=bounds), make(bounds=bounds)
        assert rows_of(with_counts) == rows_of(without)
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (with_counts, without)]
        assert plans[0].count("Aggregate [report_date") < plans[1].count("Aggregate [report_date")


def test_a_staged_table_is_written_with_methods_that_are_compiled(spark):
    """F4 to F19: the projections of report rows made one method too long for the JVM's compiler."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    with compiled(spark):
        assert spark.conf.get(limit) == "8000"
    with pytest.raises(ZeroDivisionError), compiled(spark):
        1 / 0
    assert spark.conf.get(limit) == before
    written = stage(spark.range(3), "probe")
    assert sorted(row["id"] for row in written.collect()) == [0, 1, 2] and spark.conf.get(limit) == before


def test_given_counts_spare_the_count_of_the_rows(spark, monkeypatch):
    """rows of texts that are dear to clean are not cleaned once more to count their keys."""
    from tillweave.operators import attach as joins
    from tillweave.sources.reference import CORRECTIONS_SCHEMA

    raw = spark.createDataFrame(
        [(f"a{i % 3}-X-1-2", "Old  rod" if i % 2 else "new rod", None) for i in range(40)],
        "`Kod roboczy` string, Nazwa string, `Kod wewnętrzny` string",
    ).withColumn("report_date", F.lit("2024-03-05").cast("date"))
    rows = raw.transform(staging.with_product_cells).transform(staging.clean_product_cells)
    corrections = spark.createDataFrame([("none", "none", "NONE", "keep")], CORRECTIONS_SCHEMA)
    names = stage(staging.product_names(rows, corrections), "names")
    counts = rows.groupBy("product_work_key").agg(F.count("*").alias("n_rows"))
    asked, hot_keys = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda given, *rest: asked.append(given is kept) or hot_keys(given, *rest))
    kept, bounds = counts, joins.JoinBounds(broadcast_rows=0, salt_bytes=0)
    monkeypatch.setattr(staging, "attach", lambda *args, **named: joins.attach(*args, **{**named, "bounds": bounds}))
    found = staging.clean_products(raw, corrections, names=names, counts=counts)
    assert asked == [True] and found.count() == 40


@pytest.fixture(scope="module")
def seen(spark):
    """Rows whose files ascend otherwise than their days, with several names and codes of a key, and without a day."""
    names = ("old rod", "Old  Rod plate", "small hat", None)
    cells = [
        (f"f{9 - day}.xlsx", D[day] if day else None, day % 2, 10 * day + n, ("C_" if n in (3, 4) else "") + ("ring", "hat", "large-7")[n % 3], names[n % 4], "12" if n == 5 else None)
        for day in range(7)
        for n in range(8)
        for _ in range(1 + n % 2)
    ]
    return spark.createDataFrame(
        cells,
        "source_file string, report_date date, _sheet_ord int, _row_ord long, product_code_raw string,"
        " product_name_raw string, recipe_number_raw string",
    )


def test_candidates_and_variants_come_from_fewer_rows_than_observations(spark, seen):
    """F6 to F17: every step sorted all observations again, and counted them again for every join."""
    from tillweave.plans.warehouse import build_product_model

    direct = staging.product_observations(seen)
    observed = staging.staged_observations(seen)
    assert observed.schema.simpleString() == direct.schema.simpleString() and rows_of(observed) == rows_of(direct)
    names = stage(staging.product_names(observed, source.corrections(spark)), "names")
    cells = products.code_cells(observed)
    assert cells.count() < observed.count()
    wanted = identity.candidates_from_observations(observed, names)
    assert rows_of(identity.candidates_from_observations(cells, names)) == rows_of(wanted)

    by_cell = {}
    for row in direct.collect():
        cell = tuple(row[name] for name in cells.columns[:5])
        n_rows, first = by_cell.get(cell, (0, ("~", 0)))
        by_cell[cell] = (n_rows + row["n_rows"], min(first, (row["source_file"], row["first_row"]["place"])))
    variants = products.variants_from_observations(observed, names)
    found = {(r["product_work_key"], r["product_code_raw"], r["recipe_number_clean"]): (r["n_rows"], tuple(r["first_row"])) for r in variants.collect()}
    assert found == {(cell[0], cell[2], cell[1]): kept for cell, kept in by_cell.items()}

    model = build_product_model(seen, source.corrections(spark), source.RULES)
    sums = {r["product_work_key"]: r["n_rows"] for r in model.counts.collect()}
    assert model.counts.count() == len(sums) and sum(sums.values()) == seen.count()


def test_names_are_tested_once_for_each_key(spark, seen):
    """F6 to F17: every code of a key carried all names of the key through the rules."""
    observed = staging.staged_observations(seen)
    names = stage(staging.product_names(observed, source.corrections(spark)), "names")
    resolved = stage(identity.resolve_identity(identity.candidates_from_observations(observed, names)), "identity")
    slow = products.dim_product_from_variants(products.variants_from_observations(observed, names), resolved, source.RULES)
    variants = products.variants_from_cells(products.code_cells(observed), names)
    assert "alternative_names" not in variants.columns
    fast = products.dim_product_from_variants(variants, resolved, source.RULES, names=names)
    assert rows_of(fast) == rows_of(slow) and {"INSIDE", "LISTED", "PATTERN"} <= {r["source"] for r in fast.collect()}


def test_undated_product_without_names_keeps_its_nulls(spark):
    rows = spark.createDataFrame(
        [("f.xlsx", None, 1, 1, None, ")", None)],
        "source_file string, report_date date, _sheet_ord int, _row_ord long, product_code_raw string,"
        " product_name_raw string, recipe_number_raw string",
    )
    names = staging.product_names(staging.staged_observations(rows), source.corrections(spark)).first()
    assert names["product_name_selected"] is None and names["alternative_names"] == []
