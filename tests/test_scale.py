"""What large runs leave on disk and move, seen on small tables."""

from __future__ import annotations

import os
import re
import time
from datetime import date

from pyspark.sql import functions as F

from tillweave.operators.materialize import as_laid, owned_scratch, scratch_folder, stage
from tillweave.plans import costs, facts, staging, warehouse
from tillweave.queries import report as source

DAYS = [date(2024, 1, day) for day in range(1, 32)]


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")), "sums")
    until = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < until:  # Spark deletes them beside the next steps
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(r["n"] for r in staged.collect()) == [142, 143, 143, 143, 143, 143, 143]


def test_staging_keeps_names_and_counts_only_and_the_order_of_columns(spark, sf):
    raw = source.report(spark, sf).where("spot_id_raw <= 3")
    spots = source.spots(spark, sf).where("spot_id_raw <> '2'")
    with owned_scratch(spark) as folder:
        stg = staging.build_staging(raw, spots, source.SALE_TYPES, source.corrections(spark))
        assert {name.rsplit("-", 1)[0] for name in os.listdir(folder)} == {"names", "counts"}
        rows = staging.prepare_rows(raw, spots, source.SALE_TYPES).columns
        assert stg.columns[: len(rows)] == ["product_work_key", "spot_id_raw", *(x for x in rows if x not in ("product_work_key", "spot_id_raw"))]
        assert stg.count() == raw.count()
        found = {r["spot_id_raw"] for r in stg.where("spot_mapping_found").select("spot_id_raw").distinct().collect()}
        assert 2 not in found and found
        assert not stg.where("spot_mapping_found <> (spot_name IS NOT NULL)").count()
    assert not os.path.exists(folder) and os.path.exists(scratch_folder(spark))


def daily_and_base(spark):
    cost = spark.createDataFrame(
        [(DAYS[0], 1, 2.0), (DAYS[9], 1, 3.0), (DAYS[4], 2, 5.0)], "date date, product_id int, productcost double"
    )
    days = stage(spark.createDataFrame([(day,) for day in DAYS], "date date"), "days")
    rows = [(DAYS[8], 7, 1), (DAYS[9], 7, 1), (DAYS[9], 8, 1), (DAYS[3], 7, 2), (DAYS[30], 7, 2), (DAYS[0], 7, 3), (None, 7, 1), (DAYS[0], 7, None)]
    base = spark.createDataFrame(rows, "date date, spot_id int, product_id int")
    return costs.build_productcost_daily_lookup(stage(cost, "cost"), days), base


def test_daily_costs_of_asked_days(spark):
    daily, base = daily_and_base(spark)
    expected = {(DAYS[8], 1, 2.0), (DAYS[9], 1, 3.0), (DAYS[30], 2, 5.0)}
    assert {tuple(r) for r in costs.daily_costs_of(base, daily).collect()} == expected
    twice = stage(daily.union(daily), "daily")  # a table that lies in no order and repeats its keys
    found = costs.daily_costs_of(base, twice).collect()
    assert len(found) == 3 and {tuple(r) for r in found} == expected


def test_dense_days_are_not_shuffled(spark):
    daily, base = daily_and_base(spark)
    asked = stage(base.select("date", "product_id").distinct(), "asked")
    with as_laid(spark):
        joined = daily.join(asked.hint("shuffle_hash"), ["date", "product_id"], "left_semi")
        plan = joined._jdf.queryExecution().sparkPlan().toString(), joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan[0]
    assert not re.search(r"hashpartitioning\(date#\d+, product_id#|Sort \[date#", plan[1])


def test_the_fact_by_day_reads_asked_costs_only(spark):
    daily, base = daily_and_base(spark)
    rows = base.where("date IS NOT NULL AND product_id IS NOT NULL").select(
        F.col("date").alias("report_date"), "spot_id", "product_id",
        F.lit(4.0).alias("Przyjęto"), F.lit(None).cast("double").alias("koszt-przyjęcie"),
    )
    spots = spark.createDataFrame([("7", 7), ("8", 8)], "spot_id_raw string, spot_id int")
    types = spark.createDataFrame([(1, "Przyjęto")], "movement_type_id int, movement_type_column string")
    fact = facts.build_fact_inventory_movement(rows, None, None, spots, types, daily)
    assert "Generate explode" not in fact._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["date"], r["spot_id"], r["product_id"]): r["cost"] for r in fact.collect()}
    assert found == {
        (DAYS[8], 7, 1): 8.0, (DAYS[9], 7, 1): 12.0, (DAYS[9], 8, 1): 12.0,
        (DAYS[3], 7, 2): 0.0, (DAYS[30], 7, 2): 20.0, (DAYS[0], 7, 3): 0.0,
    }


def test_prepared_rows_are_written_without_columns_that_repeat(spark, sf):
    raw = staging.normalize_columns(source.report(spark, sf).where("spot_id_raw <= 3"))
    rows = staging.prepare_rows(raw, None, source.SALE_TYPES)
    with owned_scratch(spark) as folder:
        kept = warehouse.stage_prepared(rows)
        assert kept.schema.names == rows.schema.names
        assert kept.exceptAll(rows).isEmpty() and rows.exceptAll(kept).isEmpty()
        (name,) = os.listdir(folder)
        assert not set(staging.CELLS) & set(spark.read.parquet(f"{folder}/{name}").columns)
