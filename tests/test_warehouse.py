"""Checks, configuration files and the full run."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillweave.errors import ConfigError, QualityError
from tillweave.operators.materialize import scratch_path, stage
from tillweave.plans import quality, warehouse
from tillweave.plans.facts import movement_cost_issues
from tillweave.queries import report as source
from tillweave.sources import reference, sinks

MODEL = ["dim_date", "dim_spot", "dim_sale_type", "dim_movement_type", "dim_product", "fact_sales_quantity",
         "fact_sales_gross", "fact_productcost", "fact_inventory_movement"]


@pytest.fixture(scope="module")
def small(spark, sf):
    return source.report(spark, sf).where("spot_id_raw <= 3")


def settings(spark, sf):
    return replace(source.settings(spark, sf), corrections=source.corrections(spark))


def test_full_run_and_snapshots(spark, sf, small):
    folder = scratch_path(spark, "warehouse")
    out = warehouse.run_warehouse(small, settings(spark, sf), folder, snapshot_folder=f"{folder}/snapshots")
    assert set(out) == {*MODEL, "dq_issues", "product_identity", "raw"}
    assert all(out[name].count() for name in MODEL)
    assert {k: v.count() for k, v in sinks.read_published(spark, folder).items()} == {name: out[name].count() for name in MODEL}
    assert out["raw"].count() == small.count()
    for name in warehouse.SNAPSHOTS:
        assert spark.read.parquet(f"{folder}/snapshots/{name}").count()
    assert spark.read.parquet(f"{folder}/snapshots/staging").count() == small.count()
    checks = {r["check_name"] for r in out["dq_issues"].where("severity = 'warning'").collect()}
    assert "control_mismatch" in checks and not out["dq_issues"].where("severity = 'error'").count()
    months = [x for x in os.listdir(f"{folder}/raw") if x.startswith("report_month=")]
    files = [f for m in months for f in os.listdir(f"{folder}/raw/{m}") if f.startswith("part")]
    assert len(files) <= 2 * len(months)


def test_an_error_is_written_in_full_and_nothing_is_published(spark, sf, small):
    folder = scratch_path(spark, "warehouse")
    bad = small.withColumn("spot_id_raw", F.col("spot_id_raw") + 1000)
    bad = bad.withColumn("report_date_raw", F.when(F.col("_row_ord") % 2 == 0, "31.02.26").otherwise(F.col("report_date_raw")))
    with pytest.raises(QualityError, match="staging: unmatched"):
        warehouse.run_warehouse(bad, settings(spark, sf), folder)
    issues = spark.read.parquet(f"{folder}/dq_issues").where("severity = 'error'").collect()
    assert {"unmatched", "invalid"} <= {r["check_name"] for r in issues}
    assert not sinks.versions(spark, folder)


def test_no_error_is_cut_from_the_exception(spark):
    schema = quality.ISSUES_SCHEMA
    issues = spark.createDataFrame([("c", "error", f"t{i}", "k", "d", 2) for i in range(45)], schema)
    with pytest.raises(QualityError) as found:
        quality.raise_on_errors(issues)
    assert all(f"t{i}: c, 1 issues, n=2" in str(found.value) for i in range(45))
    quality.raise_on_errors(issues.withColumn("severity", F.lit("warning")))


def test_samples_count_everything_and_list_twenty(spark):
    frame = spark.range(100).selectExpr("id % 50 AS k")
    row = quality.duplicate_issues(frame, ["k"], "t").first()
    assert row["n"] == 50 and len(row["detail"].split(", ")) == 20
    assert quality.duplicate_issues(frame.distinct(), ["k"], "t").count() == 0


def test_table_issues(spark):
    frame = spark.createDataFrame([(1, -1.0), (None, 2.0), (None, -3.0)], "a int, b double")
    found = {(r["check_name"], r["key"]): r["n"] for r in quality.table_issues(frame, "t", ["a", "b"], ["b"]).collect()}
    assert found == {("nulls", "a"): 2, ("negative", "b"): 2}
    assert [r["check_name"] for r in quality.table_issues(frame.limit(0), "t", ["a"], []).collect()] == ["empty"]
    assert quality.empty_issue(frame.limit(0), "t").count() == 1


def test_conservation(spark):
    before = spark.createDataFrame([(1.1,), (2.2,), (None,)], "a double")
    after = spark.createDataFrame([(3.3,)], "b double")
    assert quality.conservation_issues(before, after, {"a": "b"}, "t").count() == 0
    assert quality.conservation_issues(before, after.limit(0), {"a": "b"}, "t").count() == 1


def test_watched_totals_without_a_second_read(spark):
    rows = spark.range(1_000).selectExpr("id % 7 AS k", "CAST(id - 3 AS DOUBLE) AS x", "IF(id % 100 = 0, NULL, id) AS y")

    def watched(change):
        watch = quality.Watch("t", {"x": "x"}, ["k", "y"], ["x"])
        out = watch.after(change(watch.before(rows).groupBy("k").agg(F.sum("x").alias("x"), F.max("y").alias("y"))))
        return watch, stage(out, "watched")

    watch, written = watched(lambda df: df)
    before, after = watch.totals(spark.range(0))  # the written table isn't asked
    assert before["total_0"] == after["total_0"] == sum(range(-3, 997)) and after["n_rows"] == 7
    assert watch.issues(written).count() == 0
    watch, written = watched(lambda df: df.where("k > 0").withColumn("x", -F.col("x")).withColumn("y", F.lit(None)))
    found = {(r["check_name"], r["key"]): r["n"] for r in watch.issues(written).collect()}
    assert found == {("conservation", "x"): 1, ("nulls", "y"): 6, ("negative", "x"): 6}
    watch, written = watched(lambda df: df.where("k > 9"))
    assert {r["check_name"] for r in watch.issues(written).collect()} == {"conservation", "empty"}


def test_what_was_observed_twice_is_counted_again(spark):
    rows = spark.createDataFrame([(1.5,), (2.5,)], "x double")
    watch = quality.Watch("t", {"x": "x"})
    written = stage(watch.after(watch.before(rows).agg(F.sum("x").alias("x"))), "watched")
    watch._before = Observation()
    stage(rows.union(rows).observe(watch._before, F.sum(F.col("x").cast("decimal(28,8)")).alias("total_0")), "again")
    assert watch.issues(written).count() == 0
    assert watch.totals(written)[0]["total_0"] == 4


def test_missing_costs_list_their_first_keys(spark):
    rows = [(f"2024-01-{d:02d}", p, 1 + d % 2, d % 2 == 0, None if p % 3 else 2.0, 1) for d in range(1, 29) for p in range(5)]
    valued = spark.createDataFrame(rows, "date string, product_id int, movement_type_id int, is_receipt boolean, productcost double, open_rows long")
    found = {r["issue"]: r for r in movement_cost_issues(valued).collect()}
    assert {k: r["n_rows"] for k, r in found.items()} == {
        "receipt_cost_from_unit_cost": 28, "receipt_without_cost": 42, "movement_without_unit_cost": 42,
    }
    keys = json.loads(f"[{found['movement_without_unit_cost']['detail']}]")
    assert len(keys) == 20 and keys[0] == {"date": "2024-01-01", "product_id": 1, "movement_type_id": 2}
    assert movement_cost_issues(valued.where("open_rows > 1")).count() == 0
    assert quality.missing_cost_issues(valued).where("detail IS NOT NULL").count() == 3


def test_missing_columns_as_issues(spark):
    found = quality.missing_columns(spark.range(1), ["id", "a", "b"], "t").collect()
    assert [(r["check_name"], r["key"]) for r in found] == [("missing_column", "a"), ("missing_column", "b")]
    assert quality.missing_columns(spark.range(1), ["id"], "t").count() == 0


def test_csv_tables(spark):
    path = scratch_path(spark, "csv")
    frame = spark.createDataFrame([(1, "é", None), (2, "", True)], "a int, b string, c boolean")
    sinks.write_table(frame, path, "csv")
    assert spark.read.csv(path, header=True).count() == 2
    with pytest.raises(ConfigError):
        sinks.write_table(frame, path, "xml")


def test_configuration_files(spark, tmp_path):
    def put(name, content):
        path = tmp_path / name
        path.write_text(json.dumps(content, ensure_ascii=False), encoding="utf-8")
        return str(path)

    spots = reference.load_spots(spark, put("spots.json", [{"spot_id_raw": 1, "spot_name": "Ś", "city": "C", "street": "S"}]))
    assert [tuple(r) for r in spots.collect()] == [("1", "Ś", "C", "S")]
    moves = [{"movement_type_column": "a", "movement_type_name": "b", "movement_direction": "IN", "is_additional_detail": False, "parent_movement_type_column": None}]
    assert reference.load_movement_types(spark, put("moves.json", moves)).count() == 1
    types = {
        "fixed_sale_types": [{"source_column": "A", "sale_type_code": "ONE", "sale_type_name": "One"}],
        "grouped_columns": [{"target_column": "G", "source_columns": ["A"]}],
        "control_columns": [{"source_column": "Suma", "control_code": "S", "description": ""}],
        "validation_exclusions": [{"column": "A", "values": ["x"], "description": ""}],
    }
    found = reference.load_sale_types(spark, put("types.json", types))
    assert found.fixed[0].sale_type_code == "ONE" and found.exclusions[0].values == ("x",)
    names = {"month_names": {str(i): f"m{i}" for i in range(1, 13)}, "day_names": {str(i): f"d{i}" for i in range(1, 8)}}
    assert reference.load_calendar_names(spark, put("names.json", names)).months[12] == "m12"
    rules = {"default_source": "rest", "rules": [{"rule_name": "r", "priority": 1, "source": "s", "conditions": {"product_group_in": ["G"]}}]}
    assert reference.load_source_rules(spark, put("rules.json", rules)).rules[0].product_group_in == ("G",)
    fixes = {"name_corrections": {"old": {"canonical_name": "new", "canonical_group": "G", "action": "replace"}}}
    assert [tuple(r) for r in reference.load_name_corrections(spark, put("fixes.json", fixes)).collect()] == [("old", "new", "G", "replace")]
    listed = tmp_path / "lines"
    listed.mkdir()
    for at in range(3):
        (listed / f"{at}.json").write_text("".join(json.dumps({"spot_id_raw": 10 * at + i, "city": "C"}) + "\n" for i in range(4)))
    assert reference.load_spots(spark, str(listed), lines=True).count() == 12
    (listed / "bad.json").write_text('{"spot_id_raw": 1}\nnot an object\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        reference.load_spots(spark, str(listed), lines=True).collect()
    with pytest.raises(ConfigError):
        reference.load_sale_types(spark, put("bad.json", {"fixed_sale_types": []}))
    with pytest.raises(ConfigError):
        reference.load_calendar_names(spark, put("bad2.json", {"month_names": {"13": "x"}, "day_names": {}}))
